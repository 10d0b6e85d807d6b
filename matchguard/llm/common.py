"""Shared folders, materialised tables and small helpers of the corpus operators.

Every intermediate table goes to the folder that the cluster names in
``spark.checkpoint.dir``; a lost executor then costs a reread, never a result.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors and the driver see, as a URI or path.

    Only a local master may run without ``spark.checkpoint.dir``; it then gets
    one temporary folder for the session.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    key = spark.sparkContext.applicationId
    if key not in _OWN:
        _OWN[key] = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
    return _OWN[key]


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the lineage."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def discard(*frames: DataFrame | None) -> None:
    """Delete tables that :func:`materialize` wrote and no later plan reads."""
    for df in frames:
        path = getattr(df, "_scratch_path", None)
        if path:
            spark = df.sparkSession
            jvm = spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def is_empty(df: DataFrame) -> bool:
    return not df.head(1)


def join_spread(rows: DataFrame, side: DataFrame, key: str, spread: str, share: int = 10_000) -> DataFrame:
    """``rows`` left-joined with ``side``, which holds a key once, without one task for a frequent key.

    Keys that more than one in ``share`` rows hold, fewer than ``share`` of them,
    meet their value by broadcast; their rows, and those without a key, are dealt
    by ``spread``.
    """
    values = [c for c in side.columns if c != key]
    total = rows.count()
    often = rows.groupBy(key).agg(F.count("*").alias("_n")).where(F.col(key).isNotNull() & (F.col("_n") * share > total)).select(key)
    hot = often.join(side, key, "left").select(F.col(key).alias("_hot"), *(F.col(v).alias(f"_hot_{v}") for v in values))
    met = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left")
    alone = F.col(key).isNull() | F.col("_hot").isNotNull()
    dealt = met.withColumn("_at", F.when(alone, F.xxhash64(spread)).otherwise(F.col(key))).withColumn("_alone", alone)
    cold = side.select(F.col(key).alias("_cold"), *(F.col(v).alias(f"_cold_{v}") for v in values))
    out = dealt.join(cold, (F.col("_at") == F.col("_cold")) & ~F.col("_alone"), "left")
    return out.select(*rows.columns, *(F.coalesce(f"_hot_{v}", f"_cold_{v}").alias(v) for v in values))


def slices(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to at most ``rows`` rows, which bounds a task's Python memory."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def strings(column: pa.Array) -> list[str]:
    """Python strings of a text column; null becomes the empty text."""
    return ["" if x is None else x for x in column.to_pylist()]
