"""Readers of raw files, streams and lake tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions.expr import WHITE_SPACE, trimmed
from .csv_records import read_records


def read_raw_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Header CSV, all cells trimmed strings, ragged rows kept, blank lines skipped.

    Quoted cells may hold line ends, and quotes may be lazy; each file's own
    header names its cells, and a column that a file has not got is empty there.
    Of columns named alike the last counts. Adds ``source_file`` (its name), and
    ``source_path``, ``source_offset`` and ``source_line``, by which rows of
    large or equally named files are numbered.
    """
    records, layouts = read_records(spark, paths)
    names = [[n.strip(WHITE_SPACE) for n in layout] for layout in layouts]
    columns = list(dict.fromkeys(n for layout in names for n in layout if n))

    def cell(name: str) -> Column:
        out = F.lit(None).cast("string")
        for number, layout in enumerate(names):
            if name in layout:
                at = F.get("cells", F.lit(len(layout) - 1 - layout[::-1].index(name)))
                out = at if len(names) == 1 else F.when(F.col("layout") == number, at).otherwise(out)
        return trimmed(out).alias(name)

    # a record with a comma holds a cell beside others or the comma itself; only others are cut to see if they are blank
    filled = records.where(F.col("record").contains(",") | (trimmed(F.get("cells", F.lit(0))) != ""))
    return filled.select(*map(cell, columns), *(c for c in records.columns if c not in ("cells", "layout", "record", *columns)))


def read_event_stream(spark: SparkSession, options: dict[str, str], fmt: str = "kafka") -> DataFrame:
    """The raw topic from its first offset. Offsets are kept by the query's checkpoint.

    ST1: a batch is due at 1000 records or after a second (:data:`TRIGGERS`);
    ``options`` override.
    """
    return spark.readStream.format(fmt).options(**{**TRIGGERS.get(fmt, {}), **options}).load()


#: A batch's records, bytes and age, as far as each source knows them (a topic has no limit by bytes).
TRIGGERS = {
    "kafka": {"startingOffsets": "earliest", "maxOffsetsPerTrigger": "1000", "minOffsetsPerTrigger": "1000", "maxTriggerDelay": "1s"},
    "parquet": {"maxBytesPerTrigger": str(10 * 1024 * 1024)},
}

MESSAGE = T.StructType([T.StructField(n, k) for n, k in (("key", T.BinaryType()), ("value", T.BinaryType()), ("topic", T.StringType()), ("partition", T.IntegerType()), ("offset", T.LongType()), ("timestamp", T.TimestampType()))])


def read_message_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A stream of Parquet files that hold message rows: the same columns as the topic."""
    read = spark.readStream.schema(MESSAGE)
    return (read.option("maxFilesPerTrigger", max_files) if max_files else read.options(**TRIGGERS["parquet"])).parquet(path)


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """An empty input is an error."""
    df = spark.read.schema(S.BRONZE).option("recursiveFileLookup", "true").parquet(path)
    if not df.head(1):
        raise ValueError(f"no bronze rows in {path}")
    return df


def whole_line(c: str) -> Column:
    """A line that begins and ends with a bracket, white space apart."""
    return (F.col(c).startswith("{") & F.col(c).endswith("}")) | F.col(c).rlike(r"^\s*[\[{](?s:.*)[\]}]\s*$")


def _json_objects(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Objects of files that hold one, a list of them, or one (or a list) a line; only files with an object over several lines are read whole.

    Lines of such a file are told by their ends: JSON that begins every line with a bracket and ends it with one has no comma
    between two lines, so no object or list goes on from one to the next.

    Their names come to the driver, one a file as in its own listing, so a file of whole lines is never held, dealt by its name or joined.
    """
    read = spark.read.option("recursiveFileLookup", "true")
    lines = read.text(path).select("value", F.col("_metadata.file_path").alias("file")).where(F.trim("value") != "")
    broken = [r["file"] for r in lines.where(~whole_line("value")).select("file").distinct().collect()]
    texts = lines
    if broken:
        # the filter on the name reaches the listing, so no other file is opened
        whole = read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
        texts = lines.where(~F.col("file").isin(broken)).unionByName(whole.where(F.col("file").isin(broken)))
    return texts.select(F.explode(F.from_json("value", T.ArrayType(schema))).alias("o")).select("o.*")


def read_manifests(spark: SparkSession, root: str) -> DataFrame:
    """Batch manifests only, by their dated folders (defect X9), whole objects or one a line; any depth below a day."""
    offsets = S.MANIFEST["partition_offsets"].dataType
    loose = T.StructType([T.StructField(f.name, T.MapType(T.StringType(), offsets.valueType) if f.name == "partition_offsets" else f.dataType) for f in S.MANIFEST.fields])
    df = _json_objects(spark, f"{root}/year=*/", loose)
    return df.withColumn("partition_offsets", F.transform_keys("partition_offsets", lambda k, _: k.cast("int")))


def read_invalid(spark: SparkSession, path: str) -> DataFrame:
    """Rejects of any kind (:data:`~matchguard.schemas.REJECT`), from files that hold an object, a list of objects, or one a line."""
    return _json_objects(spark, path, S.REJECT)


def read_gold(spark: SparkSession, prefix: str, uri: str | None = None, mode: str = "all") -> DataFrame:
    """One artifact below the gold prefix, all of them, or the newest."""
    read = spark.read.schema(S.GOLD)
    if mode == "one":
        clean = (uri or "").rstrip("/")
        if not clean.startswith(prefix.rstrip("/") + "/") or "/../" in f"{clean}/":
            raise ValueError(f"{uri} is not below {prefix}")
        return read.parquet(clean)
    df = read.parquet(prefix)
    if mode == "all":
        return df
    files = df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("at")).distinct()
    newest = files.agg(F.max_by("path", F.struct("at", "path")).alias("path")).head()["path"]
    return read.parquet(newest) if newest else df


def read_kill_events(spark: SparkSession, path: str) -> DataFrame:
    """S16."""
    return spark.read.schema(S.SILVER_KILL_EVENTS).parquet(path)


def read_model_registry(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Versions (every folder that holds a file), their metrics and their training manifests, where there are any."""
    version = F.regexp_extract("_metadata.file_path", r"/versions/([^/]+)/", 1).alias("version")
    # names only: no file is opened for the list of versions
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").load(f"{root}/versions")
    texts = spark.read.option("recursiveFileLookup", "true")

    def of(name: str, column: str) -> DataFrame:
        return texts.option("pathGlobFilter", name).text(f"{root}/versions", wholetext=True).select(version, F.col("value").alias(column))

    return listed.select(F.regexp_extract("path", r"/versions/([^/]+)/", 1).alias("version")).distinct(), of("metrics.json", "metrics"), of("training_manifest.json", "training_manifest")
