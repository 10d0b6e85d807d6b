"""Reports over manifests, rejects, predictions and kill events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import distance, finite, ratio
from .ranks import percentiles


def pipeline_summary(manifests: DataFrame, gold: DataFrame | None = None, predictions: DataFrame | None = None) -> DataFrame:
    """A10: totals of all batches and the reference's estimates; measured counts where tables are given (defect X8)."""
    total = manifests.agg(
        F.coalesce(F.sum("total_records_read"), F.lit(0)).cast("bigint").alias("total_raw"), F.coalesce(F.sum("valid_records_count"), F.lit(0)).cast("bigint").alias("total_valid"),
        F.coalesce(F.sum(F.col("invalid_records_count") + F.col("duplicate_records_count")), F.lit(0)).cast("bigint").alias("total_invalid"), F.count("*").alias("total_batches"),
    )
    out = total.withColumns({
        "estimated_matches": F.greatest(F.col("total_batches"), F.expr("total_valid div 70")), "estimated_players": F.col("total_valid"),
        "estimated_predictions": F.col("total_valid"), "estimated_high_risk": F.floor(F.col("total_valid") * 0.05).cast("bigint"),
    })
    if gold is not None:
        out = out.crossJoin(F.broadcast(gold.agg(F.count_distinct("match_id").alias("matches"), F.count_distinct("player_id").alias("players"))))  # one row each
    if predictions is not None:
        out = out.crossJoin(F.broadcast(predictions.agg(F.count("*").alias("predictions"), F.count_if(F.col("risk_level").isin("HIGH", "CRITICAL")).alias("high_risk"))))
    return out


def retention_rate(manifests: DataFrame) -> DataFrame:
    """Valid of read records in per cent; 0 without any."""
    s = manifests.agg(F.sum("valid_records_count").alias("v"), F.sum("total_records_read").alias("r"))
    return s.select((ratio(F.col("v").cast("double"), F.col("r").cast("double")) * 100).alias("retention_rate"))


def invalid_reason_breakdown(rejects: DataFrame, reasons: str = "reasons") -> DataFrame:
    """Records and per cent of all rejected records by reason. One pass: the total rides along as a reason of its own."""
    tagged = rejects.select(F.explode(F.concat(F.array(F.lit(None).cast("string")), F.array_distinct(reasons))).alias("reason"))
    counts = tagged.groupBy("reason").agg(F.count("*").alias("records"))
    total = counts.where("reason is null").select(F.col("records").alias("total"))  # one row
    return counts.where("reason is not null").join(F.broadcast(total)).select("reason", "records", (F.col("records") * 100.0 / F.col("total")).alias("percent"))


def batch_before_after(manifests: DataFrame) -> DataFrame:
    """Long form, records before and after validation of each batch."""
    wide = manifests.select("batch_id", F.col("total_records_read").alias("before"), F.col("valid_records_count").alias("after"))
    return wide.unpivot("batch_id", ["before", "after"], "stage", "records")


def batch_throughput(manifests: DataFrame) -> DataFrame:
    """A14."""
    return manifests.select(F.substring("batch_id", 1, 8).alias("batch"), F.col("valid_records_count").alias("valid_records"), (F.col("invalid_records_count") + F.col("duplicate_records_count")).alias("rejected_records"))


def layer_row_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """Rows of each layer."""
    out = None
    for name, df in layers.items():
        part = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("layer"), "rows")
        out = part if out is None else out.unionByName(part)
    return out


def describe_features(df: DataFrame, cols: list[str]) -> DataFrame:
    """Moments and exact percentiles of each column's finite values, one row a feature."""
    long = df.select(*(F.col(c).cast("double").alias(c) for c in cols)).unpivot([], cols, "feature", "value").where(finite("value"))
    moments = long.groupBy("feature").agg(F.avg("value").alias("mean"), F.min("value").alias("min"), F.max("value").alias("max"), F.stddev_samp("value").alias("sd"))
    return moments.join(percentiles(long, "value", {"median": 0.5, "p95": 0.95, "p99": 0.99}, "feature"), "feature").select("feature", "mean", "median", "min", "max", "sd", "p95", "p99")


def dataset_overview(df: DataFrame) -> DataFrame:
    """A17."""
    return df.agg(F.count("*").alias("total_rows"), F.count_distinct("player_id").alias("players"), F.count_distinct("match_id").alias("matches"))


def risk_histogram(preds: DataFrame, bins: int = 10, score: str = "risk_score") -> DataFrame:
    """Predictions by score bin and level; a score of 1 is in the last bin."""
    at = F.least(F.floor(F.col(score).cast("double") * bins), F.lit(bins - 1)).cast("int")
    return preds.where(F.col(score).between(0, 1)).groupBy(at.alias("bin"), "risk_level").agg(F.count("*").alias("predictions"))


def risk_level_share(preds: DataFrame) -> DataFrame:
    """Count and share of each level; the total is a sum over at most a few levels."""
    counts = preds.groupBy("risk_level").agg(F.count("*").alias("predictions"))
    total = counts.agg(F.sum("predictions").alias("total"))
    return counts.join(F.broadcast(total)).select("risk_level", "predictions", (F.col("predictions").cast("double") / F.col("total")).alias("share"))


def _distance() -> Column:
    return distance("killer_position_x", "killer_position_y", "victim_position_x", "victim_position_y")


def kill_event_summary(kills: DataFrame, anomaly_distance: float = 100_000.0) -> DataFrame:
    """Events, mean distance, and kills over an unlikely distance."""
    d = _distance()
    return kills.agg(F.count("*").alias("total_events"), F.avg(d).alias("mean_distance"), F.count_if(d > anomaly_distance).alias("anomalies"))


def kill_position_grid(kills: DataFrame, cell: float) -> DataFrame:
    """Killers and victims by square of the map."""
    sides = [F.struct(F.lit(who).alias("side"), F.col(f"{who}_position_x").alias("x"), F.col(f"{who}_position_y").alias("y")) for who in ("killer", "victim")]
    rows = kills.select(F.explode(F.array(*sides)).alias("s")).select("s.*").where(finite("x") & finite("y"))
    return rows.groupBy("side", F.floor(F.col("x") / cell).cast("bigint").alias("cell_x"), F.floor(F.col("y") / cell).cast("bigint").alias("cell_y")).agg(F.count("*").alias("events"))


def contiguous_high_water_mark(acked: DataFrame, initial: int, col: str = "record_index") -> DataFrame:
    """The greatest n with initial + 1 ... n all acknowledged; no global window: the first id whose successor is missing."""
    ids = acked.select(F.col(col).cast("bigint").alias("i")).where(F.col("i") > initial).distinct()
    start = acked.sparkSession.range(1).select(F.lit(initial).cast("bigint").alias("i"))
    candidates = ids.unionByName(start)
    after = ids.select((F.col("i") - 1).alias("i"))
    return candidates.join(after, "i", "left_anti").agg(F.min("i").alias("high_water_mark"))


def distinct_filter_values(preds: DataFrame, cols: list[str]) -> DataFrame:
    """Each column's values, in one pass."""
    long = preds.select(F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in cols))).alias("s")).select("s.*")
    return long.where("value is not null").distinct()


def filter_predictions(preds: DataFrame, level: str = "all", model: str = "all") -> DataFrame:
    """Equality filters that reach the scan; "all" is none."""
    for c, v in (("risk_level", level), ("model_version", model)):
        preds = preds if v == "all" else preds.where(F.col(c) == v)
    return preds


def filter_batches(manifests: DataFrame, batch_id: str = "all") -> DataFrame:
    return manifests if batch_id == "all" else manifests.where(F.col("batch_id") == batch_id)


def player_profile(gold: DataFrame, player_id: str, cols: list[str]) -> DataFrame:
    """A player's rows, missing features 0, by match."""
    return gold.where(F.col("player_id") == player_id).select("match_id", "player_id", *(F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols)).orderBy("match_id")


def rank_predictions(preds: DataFrame, ascending: bool = False, n: int | None = None) -> DataFrame:
    """By score, ties by ids; with ``n`` only the first (no full sort)."""
    out = preds.orderBy(F.asc("risk_score") if ascending else F.desc("risk_score"), "match_id", "player_id")
    return out if n is None else out.limit(n)


def sample_rows(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    return df.orderBy(*keys).limit(n)


def unprocessed_files(files: DataFrame, done: DataFrame, path: str = "path") -> DataFrame:
    """Files not yet in the checkpoint."""
    return files.join(done.select(path), path, "left_anti")


def model_registry(versions: DataFrame, metrics: DataFrame, manifests: DataFrame, active: str | None) -> DataFrame:
    """Every version with metrics and manifest, newest first, the active one marked."""
    out = versions.join(metrics, "version", "left").join(manifests, "version", "left")
    return out.withColumn("is_active", F.col("version").eqNullSafe(F.lit(active))).orderBy(F.desc("version"))


def manifest_bronze_path(manifests: DataFrame, batch_id: str) -> str:
    """Where a batch's bronze rows are."""
    row = manifests.where(F.col("batch_id") == batch_id).select("data_object_path").head(1)
    if not row or not row[0][0]:
        raise ValueError(f"no data object for batch {batch_id}")
    return row[0][0]


def newest_object(files: DataFrame) -> DataFrame:
    """The path changed last; ties by path."""
    return files.agg(F.max_by("path", F.struct("modified", "path")).alias("path"))
