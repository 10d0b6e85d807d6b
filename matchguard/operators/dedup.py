"""Keep the first event of each id."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedup_events(df: DataFrame, order: list[str] | None = None, key: str = "event_id", keep_blank: bool = False) -> DataFrame:
    """The first row of each key by ``order``; with ``keep_blank`` rows of an empty key all stay."""
    order = order or ["partition", "offset"]
    # rows that all stay are dealt by their order columns instead of meeting in one group
    blank = F.coalesce(F.col(key), F.lit("")) == ""
    salt = F.when(blank, F.xxhash64(*order)) if keep_blank else F.lit(None)
    first = F.row_number().over(Window.partitionBy(key, "_salt").orderBy(*order))
    ranked = df.withColumn("_salt", salt.cast("bigint")).withColumn("_rank", first)
    return ranked.where((F.col("_rank") == 1) | blank if keep_blank else F.col("_rank") == 1).drop("_rank", "_salt")


def dedup_bronze(df: DataFrame, order: list[str] | None = None) -> DataFrame:
    return dedup_events(df, order or ["source_file", "source_record_index"], keep_blank=True)


def duplicate_count(df: DataFrame, key: str = "event_id") -> DataFrame:
    """How many rows deduplication would drop."""
    return df.groupBy(key).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_records"))
