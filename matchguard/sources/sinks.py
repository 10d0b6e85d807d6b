"""Writers of topics, lake layers and signals.

Lake writers replace only the partitions that they write, so a repeated batch
leaves the same files and no duplicates.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.expr import base64, date_parts, rfc3339


def event_messages(df: DataFrame) -> DataFrame:
    """Key is the match, so a match stays in order; value is JSON."""
    return df.select(F.col("match_id").cast("binary").alias("key"), F.to_json(F.struct("*")).cast("binary").alias("value"))


def invalid_messages(df: DataFrame) -> DataFrame:
    """Rejects, keyed by their file."""
    return df.select(F.col("source_file").cast("binary").alias("key"), F.to_json(F.struct("*")).cast("binary").alias("value"))


def write_topic(messages: DataFrame, topic: str, options: dict[str, str], fmt: str = "kafka", path: str | None = None) -> None:
    """A batch of messages to Kafka, or to files that the stream readers take."""
    out = messages.write.format(fmt).options(**options)
    out.option("topic", topic).save() if path is None else out.mode("append").save(path)


@contextmanager
def _open_writers(spark: SparkSession, n: int) -> Iterator[None]:
    """A task keeps ``n`` partitions open instead of sorting its rows by them first; from the next one on it sorts what is left."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    spark.conf.set(name, n)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _lake(df: DataFrame, by: list[str], path: str, fmt: str = "parquet", writers: int = 0) -> None:
    """``writers``: how many partitions a task may hold open, for rows of few; 0 sorts each task's rows by partition."""
    out = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by)
    with _open_writers(df.sparkSession, writers):
        out.option("compression", "zstd").parquet(path) if fmt == "parquet" else out.json(path)


#: A batch's rows lie below one day and batch, or few, so nothing is gained by sorting them.
BATCH_WRITERS = 4


def write_bronze(df: DataFrame, root: str, batch: Column | str, at: Column | None = None) -> None:
    """ZSTD Parquet by day of processing and batch; the same batch replaces itself."""
    when = F.current_timestamp() if at is None else at
    names = [f.name for f in S.BRONZE.fields]
    _lake(df.select(*names, *date_parts(when), (F.lit(batch) if isinstance(batch, str) else batch).alias("batch")), ["year", "month", "day", "batch"], root, writers=BATCH_WRITERS)


def write_invalid_records(df: DataFrame, root: str, batch: str, at: Column | None = None) -> None:
    """S9."""
    when = F.current_timestamp() if at is None else at
    _lake(df.select("*", *date_parts(when), F.lit(batch).alias("batch")), ["year", "month", "day", "batch"], root, "json", BATCH_WRITERS)


write_malformed = write_invalid_records  # S10: same layout, other rows


def write_manifest(df: DataFrame, root: str, batch: str, at: Column | None = None) -> None:
    """S12."""
    write_invalid_records(df, root, batch, at)


def with_bucket(df: DataFrame, buckets: int = 64) -> DataFrame:
    return df.withColumn("match_bucket", F.pmod(F.xxhash64("match_id"), F.lit(buckets)).cast("int"))


def write_silver(kills: DataFrame, pm: DataFrame, root: str, buckets: int = 64) -> None:
    """By match bucket; only buckets with rows are replaced."""
    _lake(with_bucket(kills, buckets), ["match_bucket"], f"{root}/kill_events")
    _lake(with_bucket(pm, buckets), ["match_bucket"], f"{root}/player_match")


def write_gold(df: DataFrame, root: str, buckets: int = 64) -> None:
    if not df.head(1):
        raise ValueError("no gold rows to write")
    _lake(with_bucket(df, buckets), ["match_bucket"], root)


def write_predictions(df: DataFrame, root: str, fmt: str = "parquet", by: list[str] | None = None) -> None:
    """By model version; nothing to write is an error."""
    if not df.head(1):
        raise ValueError("no predictions to write")
    _lake(df, by or ["model_version"], root, fmt)


def _now(at: Column | None) -> Column:
    return rfc3339(F.current_timestamp()) if at is None else at


def gold_ready_signals(artifacts: DataFrame, at: Column | None = None) -> DataFrame:
    """One signal for each gold artifact (batch_id, object_key, checksum_sha256, object_uri, source_manifest)."""
    return artifacts.select(
        F.lit("1.0").alias("schema_version"), F.sha2(F.concat_ws("|", "batch_id", "object_key", "checksum_sha256"), 256).alias("event_id"), F.lit(S.OP_GOLD_READY).alias("op"),
        "batch_id", "object_uri", "checksum_sha256", "source_manifest", _now(at).alias("created_at"),
    )


def model_ready_signals(models: DataFrame, at: Column | None = None) -> DataFrame:
    """From operation_id, model_version, bundle_uri and metrics (a map)."""
    return models.select(
        F.lit("1.0").alias("schema_version"), F.sha2(F.concat_ws("|", F.lit("model.ready"), "operation_id", "model_version"), 256).alias("event_id"), F.lit(S.OP_MODEL_READY).alias("op"), "operation_id",
        F.lit(S.MODEL_NAME).alias("model_name"), "model_version", F.lit(S.MODEL_FEATURE_VERSION).alias("feature_version"), "bundle_uri", "metrics", _now(at).alias("created_at"),
    )


def training_dead_letters(failed: DataFrame, at: Column | None = None) -> DataFrame:
    """Signals that cannot be served: place, payload (as text and as bytes), error cut to 2000 characters."""
    return failed.select(
        F.lit("1.0").alias("schema_version"), F.lit(S.OP_TRAINING_DLQ).alias("op"), F.sha2(F.concat_ws("|", "topic", F.col("partition").cast("string"), F.col("offset").cast("string")), 256).alias("event_id"),
        F.col("topic").alias("source_topic"), "partition", "offset", F.try_validate_utf8(F.col("value").cast("string")).alias("payload"), base64("value").alias("payload_base64"), F.substring("error", 1, 2000).alias("error"), _now(at).alias("created_at"),
    )
