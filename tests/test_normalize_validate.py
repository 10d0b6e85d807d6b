"""CSV layouts, envelopes and validators: the known vectors."""

import json

import pytest
from pyspark.sql import functions as F

from matchguard import schemas as S
from matchguard.operators import bronze, dedup, envelope, normalize, validate
from matchguard.sources import readers, sinks

HEADER = "Id,groupId,matchId,kills,damageDealt,headshotKills,walkDistance,rideDistance,swimDistance,matchDuration,winPlacePerc\n"
VALID = "player-001,group-10,match-100,5,550.5,2,1200.0,0.0,0.0,900.0,0.85\nplayer-002,group-10,match-100,2,210.0,0,850.5,0.0,0.0,900.0,0.85\n\nplayer-003,group-11,match-100,0,45.0,0,300.0,0.0,0.0,400.0,0.20\n"
INVALID = "player-004,group-12,match-101,1,100.0,3,-50.0,0.0,0.0,300.0,0.10\n\nplayer-005,group-12,match-101,invalid_kills,200.0,0,100.0,0.0,0.0,300.0,0.10\n"


def read(spark, tmp_path, text, name="in.csv"):
    (tmp_path / name).write_text(text)
    return normalize.with_record_index(readers.read_raw_csv(spark, str(tmp_path / name)))


def test_csv_rows_index_and_slices(spark, tmp_path):
    df = read(spark, tmp_path, HEADER + VALID)
    assert [(r["Id"], r["record_index"]) for r in df.orderBy("record_index").collect()] == [("player-001", 1), ("player-002", 2), ("player-003", 3)]
    assert normalize.replay_slice(df, limit=2).count() == 2
    assert normalize.replay_slice(df, start=2).count() == 2
    ragged = read(spark, tmp_path, HEADER + "a,b,c\n a , g,m,1,2,0,3,4,5,6,0.5,extra\n", "ragged.csv")
    assert [(r["Id"], r["kills"]) for r in ragged.orderBy("record_index").collect()] == [("a", ""), ("a", "1")]


def test_player_stats(spark, tmp_path):
    good, bad = normalize.split_valid_invalid(normalize.normalize(read(spark, tmp_path, HEADER + VALID), "ds"))
    assert good.count() == 3 and bad.count() == 0
    r = good.where("source.record_index = 1").head()
    want = good.select(F.sha2(F.lit("in.csv:match-100:1:player-001"), 256), F.sha2(F.lit("match-100"), 256), F.sha2(F.lit("player-001"), 256)).head()
    assert (r["event_id"], r["match_id"], r["player_id"]) == tuple(want) and r["op"] == S.OP_MATCH_SUMMARY
    assert r["payload"]["kills"] == 5 and r["payload"]["win_place_perc"] == 0.85
    _, bad = normalize.split_valid_invalid(normalize.normalize(read(spark, tmp_path, HEADER + INVALID), "ds"))
    rows = {r["raw_fields"]["Id"]: r["validation_errors"] for r in bad.collect()}
    assert rows == {"player-004": ["headshot_kills_over_kills", "walk_distance_negative"], "player-005": ["kills_invalid"]}


def test_kill_events_and_identity(spark):
    cols = "killed_by string, killer_name string, killer_placement string, killer_position_x string, killer_position_y string, map string, match_id string, time string, victim_name string, victim_placement string, victim_position_x string, victim_position_y string, source_file string, record_index long"
    rows = [
        ("SCAR-L", "SniperPro99", "4", "657725.1", "146275.2", "MIRAMAR", "abc123matchXYZ", "823", "VictimPlayer1", "5", "657000.0", "146000.0", "k.csv", 1),
        ("", "", "4.0", "4d", "NaN", "M", "m", "-1", "v", "", "", "", "k.csv", 2),
        ("", "", "", "", "", "", "", "", "", "", "", "", "k.csv", 3),
    ]
    df = spark.createDataFrame(rows, cols)
    assert normalize.detect_schema(df) == "match_deaths"
    good, bad = normalize.split_valid_invalid(normalize.normalize(df, "ds", identity="reference"))
    r = good.head()
    assert (r["op"], r["payload"]["weapon"], r["payload"]["killer_name"], r["payload"]["killer_placement"]) == (S.OP_KILL_RAW, "SCAR-L", "SniperPro99", 4)
    errors = {r["record_index"]: r["validation_errors"] for r in bad.collect()}
    assert errors[2] == ["killer_placement_invalid", "killer_position_x_invalid", "killer_position_y_invalid", "time_negative"]
    assert errors[3] == ["match_id_blank", "killer_and_victim_blank"]
    canonical = normalize.normalize(df, "ds").where("source.record_index = 1").head()
    assert canonical["payload"]["killer_name"] == canonical["player_id"]


BASE = {"schema_version": "1.0", "event_id": "a" * 64, "op": S.OP_MATCH_SUMMARY, "event_time": None, "ingest_time": "2026-07-28T02:30:00Z", "match_id": "m", "player_id": "p",
        "source": {"provider": "k", "dataset_id": "d", "source_file": "f", "record_index": 1},
        "payload": {"kills": 5, "damage_dealt": 550.5, "headshot_kills": 2, "walk_distance": 1.0, "ride_distance": 0.0, "swim_distance": 0.0, "survival_duration": 900.0, "win_place_perc": 0.85}}
KILL = BASE | {"op": S.OP_KILL_RAW, "payload": {"match_id": "m", "killer_name": "a", "victim_name": "b", "killer_placement": 1, "victim_placement": 2, "event_time_seconds": 3.0, "weapon": "w"}}


def messages(spark, values):
    rows = [(None, None if v is None else bytearray(v if isinstance(v, bytes) else json.dumps(v).encode()), "t", 2, 40 + i, None) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, readers.MESSAGE)


def reasons(spark, value):
    parsed = envelope.parse_envelopes(messages(spark, [value]))
    return validate.validate_events(envelope.envelopes(parsed)).head()["reasons"]


@pytest.mark.parametrize(("change", "payload", "want"), [
    ({}, {}, []),
    ({}, {"kills": 2, "headshot_kills": 5}, ["headshot_kills_over_kills"]),
    ({}, {"kills": -1, "damage_dealt": -50.0, "walk_distance": -10.0}, ["kills_negative", "headshot_kills_over_kills", "damage_dealt_invalid", "walk_distance_invalid"]),
    ({}, {"win_place_perc": 1.5}, ["win_place_perc_out_of_range"]),
    ({"event_id": "invalid-short-id"}, {}, ["event_id_not_sha256"]),
    ({"ingest_time": "2026-07-28", "schema_version": "2.0", "match_id": " "}, {}, ["match_id_blank", "schema_version_unknown", "ingest_time_invalid"]),
])
def test_validator_vectors(spark, change, payload, want):
    assert reasons(spark, BASE | change | {"payload": BASE["payload"] | payload}) == want


def test_kill_rules(spark):
    assert reasons(spark, KILL) == []
    assert reasons(spark, KILL | {"payload": KILL["payload"] | {"match_id": "other", "killer_placement": 0, "event_time_seconds": -1.0}}) == ["match_id_mismatch", "killer_placement_not_positive", "event_time_seconds_negative"]


def test_parsing_keeps_every_message(spark):
    values = [BASE, KILL, {"match_id": "match-100", "broken_field": True}, b"\xff\x00", None, BASE | {"payload": BASE["payload"] | {"kills": "5"}}, b"x" * 100]
    parsed = envelope.parse_envelopes(messages(spark, values), max_bytes=10_000)
    assert [r["kind"] for r in parsed.orderBy("offset").collect()] == ["stat", "kill", "malformed", "malformed", "malformed", "malformed", "malformed"]
    bad = {r["offset"]: r for r in envelope.malformed(parsed).collect()}
    assert bad[43]["payload_base64"] == "/wA=" and bad[44]["reason"] == "empty_payload" and bad[43]["reason"] == "unparseable_payload"
    cut = envelope.parse_envelopes(messages(spark, [b"y" * 100]), max_bytes=10).head()
    assert cut["reject_reason"] == "payload_too_large" and len(cut["value"]) == 10


def test_bronze_dedup_and_manifest(spark):
    parsed = envelope.parse_envelopes(messages(spark, [BASE, KILL]))
    b = bronze.to_bronze(envelope.envelopes(parsed)).drop("topic", "partition", "offset")
    assert len(b.columns) == 29 and b.columns[21] == "kills" and b.columns[28] == "win_place_perc"
    rows = {r["op"]: r for r in b.collect()}
    assert rows[S.OP_MATCH_SUMMARY]["killer_name"] == "p" and rows[S.OP_MATCH_SUMMARY]["weapon"] is None and rows[S.OP_KILL_RAW]["kills"] is None
    ids = spark.createDataFrame([("aaa", 0, 0), ("bbb", 0, 1), ("aaa", 0, 2), ("ccc", 0, 3)], "event_id string, partition int, offset long")
    assert [r[0] for r in dedup.dedup_events(ids).orderBy("offset").collect()] == ["aaa", "bbb", "ccc"]
    assert dedup.duplicate_count(ids).head()[0] == 1
    blank = spark.createDataFrame([("", 0, 0), ("", 0, 1), ("x", 0, 2), ("x", 0, 3)], "event_id string, source_file int, source_record_index long")
    assert dedup.dedup_bronze(blank).count() == 3
    off = spark.createDataFrame([(0, 5, "valid", False), (0, 15, "valid", True), (1, 100, "invalid", False), (1, 105, "malformed", False)], "partition int, offset long, status string, duplicate boolean")
    m = bronze.batch_manifest(off).head()
    assert m["partition_offsets"][0].asDict() == {"min_offset": 5, "max_offset": 15} and m["partition_offsets"][1]["max_offset"] == 105
    assert (m["total_records_read"], m["valid_records_count"], m["invalid_records_count"], m["duplicate_records_count"]) == (4, 2, 1, 1)
    assert m["batch_id"] == spark.range(1).select(F.sha2(F.lit("p0:5-15|p1:100-105|"), 256)).head()[0] == bronze.batch_id(bronze.partition_offsets(off)).head()[0]


def test_lake_paths_round_trip(spark, tmp_path):
    b = bronze.to_bronze(envelope.envelopes(envelope.parse_envelopes(messages(spark, [BASE])))).drop("topic", "partition", "offset")
    for _ in range(2):  # the same batch replaces itself
        sinks.write_bronze(b, str(tmp_path / "bronze"), "batch-abc12345", F.lit("2026-07-28 02:30:00").cast("timestamp"))
    assert (tmp_path / "bronze/year=2026/month=07/day=28/batch=batch-abc12345").is_dir()
    assert readers.read_bronze(spark, str(tmp_path / "bronze")).count() == 1
    with pytest.raises(ValueError):
        sinks.write_predictions(spark.createDataFrame([], "model_version string, x int"), str(tmp_path / "p"))
    with pytest.raises(ValueError):
        readers.read_gold(spark, "s3://lake/gold", "s3://lake/other/x", "one")


def test_scoring_and_signal_rules(spark):
    df = spark.createDataFrame([("predict", "m", "p", [1.0, 2.0]), ("predict", "m", "p", [1.0]), ("predict", "m", "p", [1.0, float("nan")]), ("x", "m", "p", [1.0, 2.0]), ("predict", " ", "p", [1.0, 2.0])], "op string, match_id string, player_id string, features array<double>")
    assert [r[0] for r in df.select(validate.scoring_error(2)).collect()] == [None, "feature_count_mismatch", "features_not_finite", "op_not_predict", "match_id_invalid"]
    sig = spark.createDataFrame([("1.0", "a" * 64, "data.dataset.gold.ready", "b" * 64, "s3://x"), ("1.0", "A" * 64, "data.dataset.gold.ready", "b" * 64, "file:/x")], "schema_version string, event_id string, op string, checksum_sha256 string, object_uri string")
    assert [r["reasons"] for r in validate.validate_gold_signal(sig).collect()] == [[], ["event_id_not_sha256", "object_uri_not_s3"]]
