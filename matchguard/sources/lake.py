"""A lake that grows by batches: a log of what is committed, which batch holds which match, and the newest rows of each match.

Every batch writes folders of its own name in each layer and then one entry of
the log, which makes them all visible at once; a batch that stops half-way
leaves folders that no reader takes. A batch that recomputes a match writes the
match's rows anew, and readers take those of its newest batch, so nothing that
was written is rewritten. ``index`` has a row for each match and batch, by which
a batch finds the bronze folders of its matches. ``compact`` writes the newest
rows of all matches as one batch that stands for those before it.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .folders import exists

LAYERS = ("silver/kill_events", "silver/player_match", "gold")
INDEX = "match_id string, day string, source_batch string"


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names_in(spark: SparkSession, folder: str) -> list[str]:
    p, fs = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file whole or not at all; False if there is one of that name.

    A store must rename atomically and refuse a taken name, as HDFS does; local
    files are linked, which does both.
    """
    folder, name = path.rsplit("/", 1)
    part = f"{folder}/.{name}-{uuid.uuid4().hex}"
    p, fs = _fs(spark, part)
    out = fs.create(p, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        uri = fs.getUri().getScheme()
        if uri == "file":
            local = lambda x: _fs(spark, x)[0].toUri().getPath()
            try:
                os.link(local(part), local(path))
            except FileExistsError:
                return False
            return True
        jvm = spark.sparkContext._jvm
        rename = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        rename[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        target, _ = _fs(spark, path)
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(p, target, rename)
        except Exception as e:  # noqa: BLE001  the JVM's error, told by its class
            if "FileAlreadyExistsException" in str(e):
                return False
            raise
        return True
    finally:
        fs.delete(p, False)


def append(spark: SparkSession, log: str, body: dict) -> int:
    """Add an entry behind the last of ``log``; several writers never take one number. Returns the number."""
    held = [n for n in names_in(spark, log) if n.endswith(".json") and n[0] != "."]
    number = int(held[-1].split(".")[0]) + 1 if held else 1
    while not put_new(spark, f"{log}/{number:020d}.json", json.dumps(body, sort_keys=True)):
        number += 1
    return number


def entries(spark: SparkSession, log: str, schema: str) -> DataFrame:
    """``number`` and the fields of ``schema`` of every entry."""
    if not exists(spark, log):
        return spark.createDataFrame([], f"number long, {schema}")
    rows = spark.read.schema(schema).option("pathGlobFilter", "*.json").json(log)
    return rows.select(F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)", 1).cast("long").alias("number"), "*")


def live_batches(spark: SparkSession, root: str) -> dict[str, int]:
    """Names of the batches that count and their place in the order; a compaction stands where the last batch that it replaces stood."""
    rows = entries(spark, f"{root}/commits", "batch string, replaces long").orderBy("number").collect()  # one row a batch
    base = max((r for r in rows if r["replaces"] is not None), key=lambda r: (r["replaces"], r["number"]), default=None)
    out = {} if base is None else {base["batch"]: base["replaces"]}
    out |= {r["batch"]: r["number"] for r in rows if r["replaces"] is None and (base is None or r["number"] > base["replaces"])}
    return out


def commit(spark: SparkSession, root: str, batch: str) -> None:
    """Make a batch visible; a repeated one is committed already."""
    if not entries(spark, f"{root}/commits", "batch string, replaces long").where(F.col("batch") == batch).head(1):
        append(spark, f"{root}/commits", {"batch": batch})


def _of(spark: SparkSession, root: str, layer: str, batches: dict[str, int]) -> DataFrame:
    """Rows of some batches of a layer, with ``batch`` (only these folders are listed as input)."""
    folders = [f"{root}/{layer}/batch={b}" for b in batches if exists(spark, f"{root}/{layer}/batch={b}")]
    if not folders:
        raise ValueError(f"no committed batch in {root}/{layer}")
    return spark.read.option("basePath", f"{root}/{layer}").parquet(*folders).withColumn("batch", F.col("batch").cast("string"))


def _order(batches: dict[str, int]):
    return F.coalesce(*(F.when(F.col("batch") == b, n) for b, n in batches.items())) if len(batches) == 1 else F.element_at(F.from_json(F.lit(json.dumps(batches)), "map<string,long>"), F.col("batch"))


def current(spark: SparkSession, root: str, layer: str) -> DataFrame:
    """The newest committed rows of each match of a layer."""
    live = live_batches(spark, root)
    owner = _of(spark, root, "index", live).groupBy("match_id").agg(F.max(_order(live)).alias("_newest"))
    rows = _of(spark, root, layer, live).withColumn("_at", _order(live))
    return rows.join(owner, "match_id").where(F.col("_at") == F.col("_newest")).drop("_at", "_newest", "batch")


def bronze(spark: SparkSession, root: str) -> DataFrame:
    """Bronze rows of committed batches."""
    names = {r["source_batch"] for r in _of(spark, root, "index", live_batches(spark, root)).select("source_batch").distinct().collect()}  # one row a batch
    return spark.read.parquet(f"{root}/bronze/events").where(F.col("batch").isin(sorted(names)))


def bronze_folders(spark: SparkSession, root: str, matches: DataFrame, batch: str) -> list[str]:
    """Bronze folders of ``batch`` and of the committed ones that hold a row of ``matches``."""
    live = live_batches(spark, root) | {batch: 0}
    found = _of(spark, root, "index", live).join(matches, "match_id", "left_semi").select("day", "source_batch").distinct().orderBy("day", "source_batch").collect()  # one row a batch
    return [f"{root}/bronze/events/{r['day']}/batch={r['source_batch']}" for r in found]


def write_part(df: DataFrame, root: str, layer: str, batch: str) -> None:
    """A batch's rows of a layer, by match, with a Bloom filter of the matches in each file; the batch replaces itself."""
    rows = df.repartitionByRange("match_id").sortWithinPartitions("match_id").withColumn("batch", F.lit(batch))
    out = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("parquet.bloom.filter.enabled#match_id", "true")
    out.partitionBy("batch").option("compression", "zstd").parquet(f"{root}/{layer}")


def part(spark: SparkSession, root: str, layer: str, batch: str, schema: StructType | None = None) -> DataFrame:
    """The rows that :func:`write_part` wrote; a batch without rows leaves no folder, and ``schema`` tells the columns."""
    path = f"{root}/{layer}/batch={batch}"
    if schema is not None and not exists(spark, path):
        return spark.createDataFrame([], schema)
    return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)


def compact(spark: SparkSession, root: str, layers: tuple[str, ...] = LAYERS) -> str | None:
    """Write the newest rows of all matches as one batch, which replaces those committed so far; batches that are committed meanwhile stay above it."""
    live = live_batches(spark, root)
    if len(live) < 2:
        return None
    last = max(live.values())
    name = f"base-{last}-{uuid.uuid4().hex[:8]}"
    for layer in layers:
        write_part(current(spark, root, layer), root, layer, name)
    write_part(_of(spark, root, "index", live).drop("batch").distinct(), root, "index", name)
    append(spark, f"{root}/commits", {"batch": name, "replaces": last})
    return name


def vacuum(spark: SparkSession, root: str, layers: tuple[str, ...] = LAYERS) -> int:
    """Delete folders of committed batches that a compaction replaced (bronze stays); readers that began before must be done."""
    live = live_batches(spark, root)
    gone = {r["batch"] for r in entries(spark, f"{root}/commits", "batch string, replaces long").collect()} - set(live)
    n = 0
    for layer in (*layers, "index"):
        for name in names_in(spark, f"{root}/{layer}"):
            if name.startswith("batch=") and name[6:] in gone:
                p, fs = _fs(spark, f"{root}/{layer}/{name}")
                n += bool(fs.delete(p, True))
    return n
