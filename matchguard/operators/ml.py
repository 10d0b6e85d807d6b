"""Training on Spark (M1-M10), metrics (A22, A23), splits (M2, J5) and pseudo-labels."""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterator
from datetime import datetime, timezone

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..sources import lake
from ..sources.folders import file_digests, scratch
from . import boosting
from .boosting import BoostedTrees
from .ranks import before, dealt, percentiles, ranked
from .reports import unprocessed_files
from .scoring import THRESHOLDS, check_thresholds
from .validate import finite_features, labeled_rows


def group_split(df: DataFrame, group: str = "match_id", test_share: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """No group on both sides; the test side has ceil(share) of the groups, by a hash of their id."""
    groups = df.select(group).distinct()
    n = math.ceil(groups.count() * test_share)
    hashed = groups.withColumn("_h", F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col(group).cast("string")), 256))
    test = ranked(hashed, ["_h", group], "_rank").where(F.col("_rank") <= n).select(group)
    return df.join(test, group, "left_anti"), df.join(test, group, "left_semi")


def fit_classifier(df: DataFrame, cols: list[str] | None = None, label: str = "is_suspicious", rounds: int = 100, depth: int = 10, **params) -> BoostedTrees:
    """M3: boosted trees from histograms."""
    return boosting.fit(df, S.FEATURES if cols is None else cols, label, rounds, depth, **params)


def score_classifier(model: BoostedTrees, df: DataFrame) -> DataFrame:
    return boosting.score(model, df)


def classification_metrics(df: DataFrame, score: str = "score", label: str = "label", threshold: float = 0.5, weight: str | None = None) -> DataFrame:
    """Precision, recall, F1 (0 where undefined), average precision, and rows; a row counts ``weight`` times.

    Average precision needs counts above each distinct score. They are prefix
    sums over range-partitioned score groups: sums inside each partition, plus
    the totals of partitions before, so no window spans all rows.
    """
    y, p = F.col(label).cast("int") == 1, F.col(score) >= threshold
    rows_of = F.count_if if weight is None else lambda c: F.sum(F.when(c, F.col(weight)).otherwise(0))
    by = df.groupBy(F.col(score).cast("double").alias("s")).agg(rows_of(F.lit(True)).alias("n"), rows_of(y).alias("pos"), rows_of(p & y).alias("tp"), rows_of(p & ~y).alias("fp"), rows_of(~p & y).alias("fn"))
    rows = dealt(by, [F.desc("s")])
    first = before(rows, {"bn": F.sum("n"), "bp": F.sum("pos")})
    run = Window.partitionBy("_part").orderBy(F.desc("s"))
    at = rows.join(F.broadcast(first), "_part").withColumns({"cn": F.sum("n").over(run) + F.col("bn"), "cp": F.sum("pos").over(run) + F.col("bp")})
    total = at.agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"), F.sum("n").alias("n"), F.sum("pos").alias("pos"), F.sum(F.col("pos") * F.col("cp") / F.col("cn")).alias("weighted"))
    d = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    precision, recall = d(F.col("tp"), F.col("tp") + F.col("fp")), d(F.col("tp"), F.col("tp") + F.col("fn"))
    return total.select(precision.alias("precision"), recall.alias("recall"), d(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"), d(F.col("weighted"), F.col("pos")).alias("average_precision"), F.coalesce("n", F.lit(0)).cast("bigint").alias("rows"))


def anomaly_score_summary(df: DataFrame, score: str = "anomaly_score") -> DataFrame:
    """The exact 5th percentile and the mean; one row, nulls without scores."""
    mean = df.agg(F.avg(score).alias("mean"))
    return mean.join(F.broadcast(percentiles(df, score, {"p05": 0.05})), how="left").select("p05", "mean")  # one row each


def pseudo_labels(df: DataFrame, ids: list[str], score: str = "anomaly_score", share: float = 0.05) -> DataFrame:
    """1 for the lowest max(1, round-half-even(n * share)) scores, ties by ids, else 0."""
    k = max(1, round(df.count() * share))
    return ranked(df, [score, *ids], "_rank").withColumn("pseudo_label", F.when(F.col("_rank") <= k, 1).otherwise(0)).drop("_rank")


# -- isolation forest (M4) ---------------------------------------------------

#: Draws are the first and second seven hex digits of an MD5, as whole numbers below this, and sums of them below the prime.
_DRAWS, _PRIME = 1 << 28, 268_435_399
_EULER = 0.5772156649015329


def _draw(text: Column, place: int) -> Column:
    return F.conv(F.substring(F.md5(text), 7 * place + 1, 7), 16, 10).cast("long")


def _average_path(n: Column) -> Column:
    """Mean depth of an unsuccessful search among n points."""
    return F.when(n > 2, 2 * (F.log(n - 1.0) + _EULER) - 2 * (n - 1.0) / n).when(n == 2, 1.0).otherwise(0.0)


def isolation_forest_fit(df: DataFrame, cols: list[str] | None = None, trees: int = 100, sample: int = 256, contamination: float = 0.05, seed: int = 42, ids: list[str] | None = None) -> dict:
    """M4: trees on bounded random samples, grown level by level as window steps, all trees at once.

    Every row draws from an MD5 of its ``ids`` (default: all its values) the trees whose sample it may
    join, so another partitioning or a repeated task draws the same; rows that
    are equal draw alike. A tree gets the ``sample`` rows of least draw. A split
    draws one of the columns that differ in its node, and a cut between their
    least and largest value. The forest (at most trees * 2 * sample nodes) comes
    to the driver as arrays, one place a node: the children of k are 2 k + 1 and 2 k + 2.
    """
    cols = S.FEATURES if cols is None else cols
    # what the draws and scores need of complete rows is written once, so the plan before it runs once
    named = ids or df.columns
    path = scratch(df.sparkSession, "forest")
    complete = finite_features(df, cols, minimum=0)
    complete.select(*cols, F.concat_ws("|", *(F.col(c).cast("string") for c in named)).alias("_name")).write.parquet(path)
    ready = df.sparkSession.read.parquet(path)
    n = ready.count()
    if not n:
        raise ValueError("fewer than 1 complete rows")
    rate = min(1.0, 4 * sample / n)
    at = ready.select(*(F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)), F.col("_name").alias("name")).withColumns({"h0": _draw(F.col("name"), 0), "h1": _draw(F.col("name"), 1)})
    draw = lambda t: F.pmod(F.col("h0") + t * F.col("h1"), F.lit(_PRIME))
    # only the trees that a row may join are expanded
    drawn = at.withColumn("tree", F.explode(F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: draw(t) <= int(rate * _PRIME)))).withColumn("draw", draw(F.col("tree")))
    rows = drawn.withColumn("k", F.row_number().over(Window.partitionBy("tree").orderBy("draw", "name"))).where(F.col("k") <= sample)
    xs, limit = [f"x{i}" for i in range(len(cols))], math.ceil(math.log2(max(2, min(sample, n))))
    rows = rows.select("tree", *xs, F.lit(0).alias("node"), F.lit(False).alias("leaf"), F.array().cast("array<struct<node:int,f:int,cut:double>>").alias("path"))
    node = Window.partitionBy("tree", "node")
    for _ in range(limit):  # rows of a tree stay together: no level shuffles
        spans = [F.struct(F.lit(i).alias("f"), F.min(x).over(node).alias("low"), F.max(x).over(node).alias("high")) for i, x in enumerate(xs)]
        rows = rows.withColumn("wide", F.filter(F.array(*spans), lambda e: e["high"] > e["low"]))
        named = F.concat_ws(":", F.lit(seed), "tree", "node")
        pick = F.get("wide", F.pmod(_draw(named, 0), F.greatest(F.size("wide"), F.lit(1))).cast("int"))
        cut = pick["low"] + (_draw(named, 1).cast("double") / float(_DRAWS)) * (pick["high"] - pick["low"])
        rows = rows.withColumn("leaf", F.col("leaf") | (F.size("wide") == 0)).withColumn("s", F.struct(F.col("node"), pick["f"].alias("f"), cut.alias("cut")))
        goes = F.when(F.get(F.array(*xs), F.col("s.f")) < F.col("s.cut"), 1).otherwise(2)
        rows = rows.withColumns({"path": F.when(F.col("leaf"), F.col("path")).otherwise(F.concat("path", F.array("s"))), "node": F.when(F.col("leaf"), F.col("node")).otherwise(2 * F.col("node") + goes)}).drop("wide", "s")
    ends = rows.groupBy("tree", "node").agg(F.count("*").alias("n"), F.first("path").alias("path"))
    leaves = ends.select("tree", "node", (F.size("path") + _average_path(F.col("n"))).alias("length"), "path").collect()
    size = 2 ** (limit + 1) - 1
    held = [{"f": [-1] * size, "cut": [0.0] * size, "length": [0.0] * size} for _ in range(trees)]
    for r in leaves:
        tree = held[r["tree"]]
        tree["length"][r["node"]] = r["length"]
        for s in r["path"]:
            tree["f"][s["node"]], tree["cut"][s["node"]] = s["f"], s["cut"]
    forest = {"cols": cols, "sample": int(min(sample, n)), "limit": limit, "trees": held, "offset": 0.0}
    low = isolation_forest_score(ready.select(*cols), forest).select("anomaly_score")
    forest["offset"] = float(percentiles(low, "anomaly_score", {"c": contamination}).head()["c"])
    return forest


def _path_sums(forest: dict):
    """An Arrow function: for rows of the forest's columns the sum of their paths' lengths over all trees, in the order of the trees."""
    size = 2 ** (forest["limit"] + 1) - 1
    f, cut, length = (np.array([t[k] for t in forest["trees"]]).reshape(-1, size) for k in ("f", "cut", "length"))
    limit = forest["limit"]

    def walk(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in parts:
            x = np.column_stack([rows.column(i).to_numpy(zero_copy_only=False) for i in range(rows.num_columns - 1)])
            flat, first = np.ascontiguousarray(x).ravel(), np.arange(len(x)) * x.shape[1]
            total = np.zeros(len(x))
            for ff, cc, ll in zip(f, cut, length, strict=True):
                at = np.zeros(len(x), dtype=np.int64)
                for _ in range(limit):
                    column = ff[at]
                    at = np.where(column < 0, at, 2 * at + 2 - (flat[first + column] < cc[at]))
                total += ll[at]
            yield pa.RecordBatch.from_arrays([rows.column(rows.num_columns - 1), pa.array(total)], names=["kept", "total"])

    return walk


def isolation_forest_score(df: DataFrame, forest: dict) -> DataFrame:
    """Complete rows with ``anomaly_score``: -2 ** (-mean path / expected path) above the contamination cut-off; negative is odd.

    The walk is over Arrow columns, one step a level for all rows of a batch.
    """
    cols, n = forest["cols"], forest["sample"]
    expected = 2 * (math.log(n - 1) + _EULER) - 2 * (n - 1) / n if n > 2 else 1.0
    ready = finite_features(df, cols, minimum=0)
    given = ready.select(*(F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)), F.struct("*").alias("kept"))
    walked = given.mapInArrow(_path_sums(forest), T.StructType([given.schema["kept"], T.StructField("total", T.DoubleType())]))
    mean = F.col("total") / max(1, len(forest["trees"]))
    return walked.withColumn("anomaly_score", -F.pow(F.lit(2.0), -mean / expected) - forest["offset"]).select(*(F.col("kept")[c].alias(c) for c in ready.columns), "anomaly_score")


# -- training paths (M1, M5, M6) ---------------------------------------------


def train_supervised(gold: DataFrame, label: str = "is_suspicious", **params) -> tuple[BoostedTrees, dict]:
    """M6."""
    rows = labeled_rows(gold, label)
    train, test = group_split(rows)
    model = fit_classifier(train, label=label, **params)
    scored = score_classifier(model, test).select(F.col("risk_score").alias("score"), F.col(label).cast("int").alias("label"))
    return model, {"mode": "supervised", **classification_metrics(scored).head().asDict()}


def _written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table of their own, for what reads them more than once."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def train_unsupervised(gold: DataFrame, ids: list[str] | None = None, trees: int = 100, **params) -> tuple[BoostedTrees, dict]:
    """M5: isolation forest, pseudo-labels, a surrogate classifier and its F1 on the training rows."""
    ids = ids or ["match_id", "player_id"]
    rows = finite_features(gold)
    scored = _written(isolation_forest_score(rows, isolation_forest_fit(rows, trees=trees, ids=ids)), "anomaly-scores")
    labelled = _written(pseudo_labels(scored, ids), "pseudo-labels")
    # the training ends with the score of every training row, so no row walks the trees again
    model, again = boosting.fit_scored(labelled, S.FEATURES, "pseudo_label", **params)
    metrics = classification_metrics(again, weight="weight").head().asDict()
    return model, {"mode": "unsupervised", "surrogate_f1": metrics["f1"], "rows": metrics["rows"], **{f"anomaly_{k}": v for k, v in anomaly_score_summary(scored).head().asDict().items()}}


def train(gold: DataFrame, label: str = "is_suspicious", **params) -> tuple[BoostedTrees, dict]:
    """M1: supervised if any row has a label."""
    if gold.limit(20).count() < 20:
        raise ValueError("training needs 20 rows")
    if label in gold.columns and gold.where(F.col(label).isNotNull()).head(1):
        return train_supervised(gold, label, **params)
    return train_unsupervised(gold, **params)


# -- bundles (M7-M10) ---------------------------------------------------------


def model_version(event_id: str, checksum: str) -> str:
    """M7: a retry of one signal names one version."""
    return "v-" + hashlib.sha256(f"{event_id}|{checksum}".encode()).hexdigest()[:16]


def version_of(event_id: str, checksum: str) -> Column:
    """M7 as a column."""
    return F.concat(F.lit("v-"), F.substring(F.sha2(F.concat_ws("|", event_id, checksum), 256), 1, 16))


def read_versions(spark: SparkSession, root: str) -> DataFrame:
    """S21, ST9: ``number, version`` in order of making; names say nothing of it."""
    return lake.entries(spark, f"{root}/log", "version string").groupBy("version").agg(F.max("number").alias("number")).select("number", "version")


def _log_version(spark: SparkSession, root: str, version: str) -> None:
    if not lake.entries(spark, f"{root}/log", "version string").where(F.col("version") == version).head(1):
        lake.append(spark, f"{root}/log", {"version": version})


REQUIRED = ["feature_schema.json", "threshold_policy.json", "metrics.json", "training_manifest.json"]


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def _files(spark: SparkSession, path: str) -> dict[str, str]:
    """Name below ``path`` to SHA-256 of every file, hashed on the executors."""
    rows = file_digests(spark, path).collect()
    tail = path.split("://")[-1].split(":", 1)[-1].rstrip("/") + "/"
    return {r["path"].split(tail, 1)[1]: r["sha"] for r in rows if "/_" not in r["path"] and not r["path"].endswith(".crc")}


def save_bundle(model: BoostedTrees, metrics: dict, root: str, version: str, cols: list[str] | None = None, thresholds: dict | None = None, source: dict | None = None) -> str:
    """M8: model and metadata under ``root/versions/<version>``; the same version with other content is an error."""
    spark = SparkSession.getActiveSession()
    cols, path = S.FEATURES if cols is None else cols, f"{root}/versions/{version}"
    if not 1 <= len(cols) <= 128:
        raise ValueError("a bundle has 1 to 128 features")
    docs = {
        "feature_schema.json": {"features": cols, "feature_version": S.FEATURE_VERSION}, "threshold_policy.json": check_thresholds(thresholds or THRESHOLDS),
        "metrics.json": {k: v for k, v in metrics.items()}, "training_manifest.json": {"version": version, **(source or {})},
    }
    text = {k: json.dumps(v, sort_keys=True) for k, v in docs.items()}
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{path}/checksums.json")
    if p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        held = _files(spark, path)
        if any(held.get(k) != hashlib.sha256(v.encode()).hexdigest() for k, v in text.items()):
            raise ValueError(f"version {version} exists with other content")
        _log_version(spark, root, version)  # a try that stopped before this
        return path
    model.save(spark, f"{path}/model")
    for name, body in text.items():
        _write_text(spark, f"{path}/{name}", body)
    _write_text(spark, f"{path}/checksums.json", json.dumps(_files(spark, path), sort_keys=True))
    _log_version(spark, root, version)
    return path


def verify_bundle(spark: SparkSession, path: str) -> dict:
    """M9: every listed file is there with its checksum; returns the feature schema."""
    text = spark.read.text(f"{path}/checksums.json", wholetext=True).head()[0]
    listed, held = json.loads(text), _files(spark, path)
    missing = [f for f in REQUIRED if f not in listed]
    wrong = [f for f, sha in listed.items() if held.get(f) != sha]
    if missing or wrong:
        raise ValueError(f"bundle {path}: missing {missing}, changed {wrong}")
    schema = json.loads(spark.read.text(f"{path}/feature_schema.json", wholetext=True).head()[0])
    if not 1 <= len(schema["features"]) <= 128:
        raise ValueError("a bundle has 1 to 128 features")
    return schema


def load_bundle(spark: SparkSession, path: str) -> tuple[BoostedTrees, dict]:
    schema = verify_bundle(spark, path)
    return BoostedTrees.load(spark, f"{path}/model"), schema


def train_incremental(spark: SparkSession, gold_path: str, root: str, **params) -> str | None:
    """Trains on all gold if a file is new, then records what it used; None without news."""
    files = spark.read.parquet(gold_path).select(F.col("_metadata.file_path").alias("path")).distinct()
    done_path = f"{root}/processed_files"
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(done_path)
    exists = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
    fresh = unprocessed_files(files, spark.read.parquet(done_path)) if exists else files
    if not fresh.head(1):
        return None
    gold = spark.read.parquet(gold_path)
    model, metrics = train(gold, **params)
    version = f"v-all-{int(datetime.now(timezone.utc).timestamp() * 1000)}"
    save_bundle(model, metrics, root, version)
    fresh.withColumn("version", F.lit(version)).withColumn("rows", F.lit(gold.count())).write.mode("append").parquet(done_path)
    return version
