"""Exact ranks and percentiles of whole columns, from counts by range of keys.

Rows are dealt to tasks by range and written once with the number of their
task, so later steps read the same division however Spark plans or repeats
them. A rank is a rank inside a task plus the rows of tasks before it; no
window, buffer or limit spans all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.folders import scratch


def dealt(df: DataFrame, by: Sequence[Column | str]) -> DataFrame:
    """The rows in ranges of ``by``, with ``_part`` rising with the range."""
    path = scratch(df.sparkSession, "ranges")
    df.repartitionByRange(*by).withColumn("_part", F.spark_partition_id()).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def before(parts: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """``_part`` and, for every named sum, its total over earlier parts (one row a part: it may be broadcast)."""
    totals = parts.groupBy("_part").agg(*(c.alias(f"_t_{n}") for n, c in sums.items()))
    earlier = totals.withColumnRenamed("_part", "_q")
    met = totals.select("_part").join(F.broadcast(earlier), F.col("_q") < F.col("_part"), "left")
    return met.groupBy("_part").agg(*(F.coalesce(F.sum(f"_t_{n}"), F.lit(0)).alias(n) for n in sums))


def ranked(df: DataFrame, by: Sequence[Column | str], name: str = "rank") -> DataFrame:
    """Adds the 1-based place of each row by ``by``, whose ties should be few."""
    rows = dealt(df, by)
    first = before(rows, {"_before": F.count("*")})
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*by))
    return rows.join(F.broadcast(first), "_part").withColumn(name, F.col("_before") + inside).drop("_part", "_before")


def percentiles(df: DataFrame, value: str, shares: dict[str, float], key: str | None = None) -> DataFrame:
    """The exact percentiles (linear between neighbours) of ``value``, by name in ``shares``, for each of a few ``key`` values.

    Equal values are counted first, so a value that many rows share is one row. Nulls are left out.
    """
    keyed = df.select((F.lit(0) if key is None else F.col(key)).alias("_key"), F.col(value).cast("double").alias("_v")).where("_v is not null")
    rows = dealt(keyed.groupBy("_key", "_v").agg(F.count("*").alias("_n")), ["_key", "_v"])
    first = before(rows, {"_before": F.sum("_n")})
    run = Window.partitionBy("_part").orderBy("_key", "_v")
    upto = rows.join(F.broadcast(first), "_part").withColumn("_upto", F.col("_before") + F.sum("_n").over(run))
    span = rows.groupBy("_key").agg(F.sum("_n").alias("_rows"))
    start = span.alias("a").join(F.broadcast(span.alias("b")), F.col("b._key") < F.col("a._key"), "left").groupBy(F.col("a._key").alias("_key")).agg(F.first("a._rows").alias("_rows"), F.coalesce(F.sum("b._rows"), F.lit(0)).alias("_start"))
    wanted = F.array(*(F.struct(F.lit(n).alias("name"), ((F.col("_rows") - 1) * F.lit(float(p))).alias("at")) for n, p in shares.items()))
    targets = start.select("_key", "_start", F.explode(wanted).alias("w")).select("_key", "w.name", "w.at", "_start")
    # the rows that hold the places floor(at) and floor(at) + 1 of their key
    low = F.floor("at")
    held = lambda place: (F.col("_upto") - F.col("_start") > place) & (F.col("_upto") - F.col("_n") - F.col("_start") <= place)
    near = upto.join(F.broadcast(targets), "_key").where(held(low) | held(low + 1))
    pair = near.groupBy("_key", "name").agg(F.first("at").alias("at"), F.max(F.when(held(low), F.col("_v"))).alias("lo"), F.max(F.when(held(low + 1), F.col("_v"))).alias("hi"))
    between = F.col("at") - F.floor("at")
    out = F.when((between == 0) | F.col("hi").isNull(), F.col("lo")).otherwise((1 - between) * F.col("lo") + between * F.col("hi"))
    wide = pair.groupBy("_key").agg(*(F.max(F.when(F.col("name") == n, out)).alias(n) for n in shares))
    return wide.drop("_key") if key is None else wide.withColumnRenamed("_key", key)
