"""The bronze table and batch audit records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.expr import rfc3339

_KILL = ["killer_name", "victim_name", "killer_placement", "victim_placement", "killer_position_x", "killer_position_y", "victim_position_x", "victim_position_y", "event_time_seconds", "weapon"]


def to_bronze(envelopes: DataFrame) -> DataFrame:
    """29 columns: stat rows name their player as killer and have no telemetry, kill rows have no metrics."""
    kind = {f.name: f.dataType for f in S.BRONZE.fields}
    is_kill = F.col("kind") == "kill"

    def kill(c: str) -> Column:
        v = F.col(f"kill.{c}").cast(kind[c])
        return (F.when(is_kill, v).otherwise(F.col("player_id")) if c == "killer_name" else F.when(is_kill, v)).alias(c)

    common = [F.col(c) for c in ("event_id", "schema_version", "op", "event_time", "ingest_time", "match_id", "player_id")]
    source = [F.col(f"source.{c}").alias(f"source_{c}" if not c.startswith("source") else c) for c in ("provider", "dataset_id", "source_file", "record_index")]
    stat = [F.when(~is_kill, F.col(f"stat.{c}")).alias(c) for c in S.METRICS]
    place = [c for c in ("topic", "partition", "offset") if c in envelopes.columns]
    names = [f.name for f in S.BRONZE.fields]
    return envelopes.select(*common, *source, *(kill(c) for c in _KILL), *stat, *place).select(*names, *place)


def union_envelopes(stats: DataFrame, kills: DataFrame) -> DataFrame:
    """Normalised stat and kill envelopes as one table with both payloads."""
    one = stats.withColumnRenamed("payload", "stat").withColumn("kind", F.lit("stat"))
    two = kills.withColumnRenamed("payload", "kill").withColumn("kind", F.lit("kill"))
    return one.unionByName(two, allowMissingColumns=True)


def partition_offsets(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """First and last offset of each topic partition (in each batch)."""
    return df.groupBy(*(by or []), "partition").agg(F.min("offset").alias("min_offset"), F.max("offset").alias("max_offset"))


def offsets_key(entries: Column) -> Column:
    """``p0:5-15|p1:100-105|`` from an array of structs partition, min_offset, max_offset."""
    part = lambda x: F.concat(F.lit("p"), x["partition"].cast("string"), F.lit(":"), x["min_offset"].cast("string"), F.lit("-"), x["max_offset"].cast("string"), F.lit("|"))
    return F.array_join(F.transform(F.array_sort(entries), part), "")


def batch_id(offsets: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The same offsets always give the same id."""
    entries = F.collect_list(F.struct("partition", "min_offset", "max_offset"))
    return offsets.groupBy(*(by or [])).agg(F.sha2(offsets_key(entries), 256).alias("batch_id"))


def batch_manifest(messages: DataFrame, path: Column | None = None, checksum: Column | None = None, now: Column | None = None, by: list[str] | None = None, topic: Column | str = "pubg.v1.player-stat.raw") -> DataFrame:
    """One audit row a batch from message rows with partition, offset, status, duplicate.

    ``status`` is valid, invalid or malformed; valid counts before deduplication.
    """
    by = by or []
    per = messages.groupBy(*by, "partition").agg(
        F.min("offset").alias("min_offset"), F.max("offset").alias("max_offset"), F.count("*").alias("n"), F.count_if(F.col("status") == "valid").alias("v"),
        F.count_if(F.col("status") == "invalid").alias("i"), F.count_if((F.col("status") == "valid") & F.col("duplicate")).alias("d"),
    )
    entries = F.collect_list(F.struct("partition", "min_offset", "max_offset"))
    return per.groupBy(*by).agg(F.sum("n").alias("total_records_read"), F.sum("v").alias("valid_records_count"), F.sum("i").alias("invalid_records_count"), F.sum("d").alias("duplicate_records_count"), entries.alias("_e")).select(
        *by, F.sha2(offsets_key(F.col("_e")), 256).alias("batch_id"), (F.lit(topic) if isinstance(topic, str) else topic).alias("source_topic"),
        F.map_from_entries(F.transform(F.array_sort("_e"), lambda x: F.struct(x["partition"].cast("int"), F.struct(x["min_offset"].cast("bigint").alias("min_offset"), x["max_offset"].cast("bigint").alias("max_offset"))))).alias("partition_offsets"),
        "total_records_read", "valid_records_count", "invalid_records_count", "duplicate_records_count",
        (F.lit(None).cast("string") if path is None else path).alias("data_object_path"), (F.lit(None).cast("string") if checksum is None else checksum).alias("checksum_sha256"),
        (rfc3339(F.current_timestamp()) if now is None else now).alias("processing_timestamp"),
    )


def contract_manifest(manifests: DataFrame) -> DataFrame:
    """The contract's form: one row for each partition of a batch; the counts are the batch's."""
    each = manifests.select("*", F.explode("partition_offsets").alias("kafka_partition", "o"))
    return each.select(
        "batch_id", "source_topic", "kafka_partition", F.col("o.min_offset").alias("first_offset"), F.col("o.max_offset").alias("last_offset"), F.col("total_records_read").alias("record_count"),
        F.col("valid_records_count").alias("valid_record_count"), F.col("invalid_records_count").alias("invalid_record_count"), F.col("duplicate_records_count").alias("duplicate_record_count"),
        F.col("data_object_path").alias("data_object"), F.col("checksum_sha256").alias("checksum"), F.lit("completed").alias("status"), F.col("processing_timestamp").alias("processed_at"),
    )
