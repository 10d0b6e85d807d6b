"""Topic messages to envelopes (P9, P10): nothing malformed is lost, nothing blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.expr import base64


def classify_payload(df: DataFrame, max_bytes: int = 1_048_576) -> DataFrame:
    """Adds ``reject_reason``: empty or over-long payloads; the latter keep a bounded prefix."""
    size = F.octet_length("value")
    reason = F.when(F.col("value").isNull() | (size == 0), F.lit("empty_payload")).when(size > max_bytes, F.lit("payload_too_large"))
    return df.withColumn("reject_reason", reason).withColumn("value", F.when(size > max_bytes, F.substring("value", 1, max_bytes)).otherwise(F.col("value")))


def _needed(parsed: str, names: list[str]) -> Column:
    out = F.lit(True)
    for n in names:
        out = out & F.col(f"{parsed}.{n}").isNotNull()
    return out


_COMMON = ["schema_version", "event_id", "op", "ingest_time", "match_id", "player_id", "source.provider", "source.dataset_id", "source.source_file", "source.record_index"]
_STAT = [f"payload.{c}" for c in ("kills", "damage_dealt", "headshot_kills", "walk_distance", "ride_distance", "swim_distance", "survival_duration")]


def parse_envelopes(df: DataFrame, max_bytes: int = 1_048_576) -> DataFrame:
    """Adds ``kind`` (kill, stat or malformed), ``kill`` and ``stat`` structs, and ``reject_reason``.

    The kill shape is tried first. Fields that are missing or of another type
    leave a null; a null in a required field means that the shape does not fit.
    """
    text = F.when(F.col("reject_reason").isNull(), F.col("value").cast("string"))
    df = classify_payload(df, max_bytes)
    # a generator of one row: conditions on the parsed fields stay above it, so each text is parsed once for each shape and not once a use
    both = F.struct(F.from_json(text, S.KILL_EVENT_ENVELOPE).alias("kill"), F.from_json(text, S.PLAYER_STAT_ENVELOPE).alias("stat"))
    df = df.select("*", F.inline(F.array(both)).alias("kill", "stat"))
    # the payload's match id marks the kill shape: stats have none
    is_kill = _needed("kill", [*_COMMON, "payload.match_id"])
    is_stat = _needed("stat", [*_COMMON, *_STAT])
    kind = F.when(F.col("reject_reason").isNotNull(), "malformed").when(is_kill, "kill").when(is_stat, "stat").otherwise("malformed")
    df = df.withColumn("kind", kind)
    return df.withColumn("reject_reason", F.when((F.col("kind") == "malformed") & F.col("reject_reason").isNull(), F.lit("unparseable_payload")).otherwise(F.col("reject_reason"))).withColumn("kill", F.when(F.col("kind") == "kill", F.col("kill"))).withColumn("stat", F.when(F.col("kind") == "stat", F.col("stat")))


def malformed(parsed: DataFrame) -> DataFrame:
    """S10 rows: where the message was, why it is malformed, and its bytes."""
    return parsed.where("kind = 'malformed'").select("topic", "partition", "offset", F.col("reject_reason").alias("reason"), base64("value").alias("payload_base64"), F.sha2(F.coalesce("value", F.lit("").cast("binary")), 256).alias("payload_sha256"))


def opened(parsed: DataFrame) -> DataFrame:
    """Common fields, source, and both payloads (one is null; both of malformed messages) in place of the two shapes."""
    def pick(f: str) -> Column:
        return F.coalesce(F.col(f"kill.{f}"), F.col(f"stat.{f}")).alias(f)

    fields = ["schema_version", "event_id", "op", "event_time", "ingest_time", "match_id", "player_id", "source"]
    return parsed.select(*(c for c in parsed.columns if c not in ("kill", "stat")), *(pick(f) for f in fields), F.col("kill.payload").alias("kill"), F.col("stat.payload").alias("stat"))


def envelopes(parsed: DataFrame) -> DataFrame:
    """Well-formed messages as one table: common fields, source, and both payloads (one is null)."""
    place = [c for c in ("topic", "partition", "offset") if c in parsed.columns]
    rows = opened(parsed.where("kind <> 'malformed'").select(*place, "kind", "kill", "stat"))
    return rows.select(*place, "kind", *(c for c in rows.columns if c not in (*place, "kind")))
