"""Folders that driver and executors share, and checksums of what lies in them."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import quote

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under ``spark.checkpoint.dir``; only a local master may do without that setting."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def remove(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside are deleted as each plan is done, and not whenever the driver's garbage is collected."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


@contextmanager
def kept(df: DataFrame, folder: str) -> Iterator[DataFrame]:
    """The rows as a table in a new folder below ``folder``, deleted in the end: compressed by column, where cached rows with nested fields are not."""
    spark, path = df.sparkSession, f"{folder}/{uuid.uuid4().hex}"
    try:
        df.write.option("compression", "zstd").parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove(spark, path)


def _open(path: str):
    """A Hadoop path's bytes as they are."""
    scheme, sep, rest = path.partition(":")
    if not sep or scheme == "file":
        return fs.LocalFileSystem().open_input_stream("/" + (rest if sep else path).lstrip("/"), compression=None)
    files, name = fs.FileSystem.from_uri(quote("s3" + path[3:] if scheme == "s3a" else path, safe=":/@"))
    return files.open_input_stream(name, compression=None)


def sha256_of(path: str, chunk: int = 4 << 20) -> str:
    """The SHA-256 of a file of any size, which is never held: one range of ``chunk`` bytes after the other."""
    digest = hashlib.sha256()
    with _open(path) as f:
        while part := f.read(chunk):
            digest.update(part)
    return digest.hexdigest()


def file_digests(spark: SparkSession, paths: str | list[str], pattern: str = "*", whole: int = 32 << 20) -> DataFrame:
    """``path, sha`` (SHA-256 of the bytes) of all files below some folders but empty ones, which Spark's file sources pass over; hashed on the executors.

    Files of up to ``whole`` bytes are read as rows without Python; larger ones,
    which no row could hold beyond 2 GB, go range by range through one digest, with the same result.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(paths)

    def stream(parts):
        for rows in parts:
            yield rows.assign(sha=[sha256_of(p) for p in rows["path"]])

    # the filter on the length reaches the source, so no content of a large file is read as a row
    small = files.where(F.col("length") <= whole).select("path", F.sha2("content", 256).alias("sha"))
    return small.unionByName(files.where(F.col("length") > whole).select("path").mapInPandas(stream, "path string, sha string"))


def checksums(spark: SparkSession, paths: list[str], pattern: str = "*.parquet") -> DataFrame:
    """``folder, checksum_sha256`` of data folders: the SHA-256 over the sorted SHA-256 of their files."""
    each = file_digests(spark, paths, pattern).select(F.regexp_replace("path", r"/[^/]*$", "").alias("folder"), "sha")
    return each.groupBy("folder").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("sha")), "\n"), 256).alias("checksum_sha256"))
