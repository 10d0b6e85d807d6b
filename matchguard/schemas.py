"""Schemas of the tables and messages, and the feature contract."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {"string": T.StringType(), "long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType()}


def _schema(*groups: tuple[str, str | T.DataType]) -> T.StructType:
    """Fields in order, from (names, type) groups; needs no session, so executors can import it."""
    return T.StructType([T.StructField(n, _TYPES.get(kind, kind) if isinstance(kind, str) else kind) for names, kind in groups for n in names.split()])


_PLACES = "killer_position_x killer_position_y victim_position_x victim_position_y"
_DISTANCES = "walk_distance ride_distance swim_distance survival_duration win_place_perc"

SOURCE = _schema(("provider dataset_id source_file", "string"), ("record_index", "long"))
PLAYER_STAT_PAYLOAD = _schema(("kills", "long"), ("damage_dealt", "double"), ("headshot_kills", "long"), (_DISTANCES, "double"))
KILL_EVENT_PAYLOAD = _schema(("match_id killer_name victim_name", "string"), ("killer_placement victim_placement", "int"), (f"{_PLACES} event_time_seconds", "double"), ("weapon", "string"))
_ENVELOPE = ("schema_version event_id op event_time ingest_time match_id player_id", "string")

PLAYER_STAT_ENVELOPE = _schema(_ENVELOPE, ("source", SOURCE), ("payload", PLAYER_STAT_PAYLOAD))
KILL_EVENT_ENVELOPE = _schema(_ENVELOPE, ("source", SOURCE), ("payload", KILL_EVENT_PAYLOAD))

BRONZE = _schema(
    ("event_id schema_version op event_time ingest_time match_id player_id source_provider source_dataset_id source_file", "string"),
    ("source_record_index", "long"),
    ("killer_name victim_name", "string"),
    ("killer_placement victim_placement", "long"),
    (f"{_PLACES} event_time_seconds", "double"),
    ("weapon", "string"),
    ("kills", "long"),
    ("damage_dealt", "double"),
    ("headshot_kills", "long"),
    (_DISTANCES, "double"),
)
SILVER_KILL_EVENTS = _schema(("event_id match_id event_time", "string"), ("event_time_seconds", "double"), ("killer_name victim_name", "string"), (_PLACES, "double"), ("weapon", "string"), ("damage_dealt", "double"))
SILVER_PLAYER_MATCH = _schema(("match_id player_id", "string"), ("kills headshot_kills", "long"), (f"damage_dealt {_DISTANCES}", "double"))
GOLD = _schema(
    ("match_id player_id", "string"), ("kills", "long"), ("minimum_kill_interval_seconds median_kill_distance_coordinate_units", "double"),
    ("short_kill_interval_count unique_weapons_used", "long"), ("feature_version created_at", "string"),
)
MANIFEST = _schema(
    ("batch_id source_topic", "string"), ("partition_offsets", T.MapType(T.IntegerType(), _schema(("min_offset max_offset", "long")))),
    ("total_records_read valid_records_count invalid_records_count duplicate_records_count", "long"), ("data_object_path checksum_sha256 processing_timestamp", "string"),
)
#: What a reject may hold: of validation, of malformed payloads, of the replay's normalisation.
REJECT = _schema(
    ("event_id match_id player_id", "string"), ("reasons", T.ArrayType(T.StringType())), ("topic", "string"), ("partition", "int"), ("offset", "long"), ("reason payload_base64 payload_sha256 source_file", "string"),
    ("record_index", "long"), ("raw_fields", T.MapType(T.StringType(), T.StringType())), ("validation_errors", T.ArrayType(T.StringType())), ("failed_at", "string"),
)
#: The signal that a gold artifact is there, and the one that a model is.
GOLD_SIGNAL = _schema(("schema_version event_id op batch_id object_uri checksum_sha256 source_manifest created_at", "string"))
MODEL_SIGNAL = _schema(("schema_version event_id op operation_id model_name model_version feature_version bundle_uri", "string"), ("metrics", T.MapType(T.StringType(), T.StringType())), ("created_at", "string"))

OP_MATCH_SUMMARY = "data.player_stat.match_summary"
OP_KILL_DEATH = "data.kill_event.kill_death"
OP_KILL_RAW = "data.kill_event.raw"
FEATURE_VERSION = "v1.0.0"
#: The signals' op codes, and the model's name and feature version in them.
OP_GOLD_READY = "data.dataset.gold.ready"
OP_MODEL_READY = "ml.model.ready"
OP_TRAINING_DLQ = "ml.dataset.gold.ready.dlq"
MODEL_NAME, MODEL_FEATURE_VERSION = "pubg-risk", "kill-event-player-match-v1"

#: The model's inputs, in order.
FEATURES = ["kills", "minimum_kill_interval_seconds", "median_kill_distance_coordinate_units", "short_kill_interval_count", "unique_weapons_used"]
#: The evidence step's inputs, in order.
EVIDENCE_FEATURES = ["kills_per_minute", "damage_per_minute", "headshot_ratio", "damage_per_kill", "movement_per_minute", "performance_versus_lobby"]
#: Evidence features whose column has another name.
EVIDENCE_COLUMNS = {"performance_versus_lobby": "performance_vs_lobby"}
METRICS = ["kills", "headshot_kills", "damage_dealt", "walk_distance", "ride_distance", "swim_distance", "survival_duration", "win_place_perc"]
