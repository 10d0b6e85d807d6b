"""Rate features and lobby-relative ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import finite


def _rate(v: Column) -> Column:
    """Infinite and NaN values are 0."""
    return F.when(finite(v), v).otherwise(F.lit(0.0))


def rate_features(df: DataFrame) -> DataFrame:
    """F1-F6; a survival of 0 counts as one second."""
    seconds = F.when(F.col("survival_duration") == 0, F.lit(1.0)).otherwise(F.col("survival_duration"))
    minutes = seconds / 60
    kills = F.greatest(F.col("kills"), F.lit(1).cast("bigint")).cast("double")
    total = F.col("walk_distance") + F.col("ride_distance") + F.col("swim_distance")
    per = lambda a, b: _rate(F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0)))
    return df.withColumns({
        "kills_per_minute": per(F.col("kills"), minutes), "damage_per_minute": per(F.col("damage_dealt"), minutes),
        "headshot_ratio": F.when(F.col("kills") == 0, F.lit(0.0)).otherwise(per(F.col("headshot_kills"), kills)), "total_distance": _rate(total),
        "damage_per_kill": per(F.col("damage_dealt"), kills), "movement_per_minute": per(total, minutes),
    })


def lobby_features(df: DataFrame, names: dict[str, bool], value: str = "damage_dealt") -> DataFrame:
    """``value`` against its match's median under each name, in standard deviations where the name says True; one grouped pass and one join for all."""
    lobby = df.groupBy("match_id").agg(F.percentile(value, F.lit(0.5)).alias("_median"), F.stddev_samp(value).alias("_sd"))
    gap = F.col(value) - F.col("_median")
    in_deviations = F.coalesce(F.try_divide(gap, F.col("_sd")), F.lit(0.0))
    return df.join(lobby, "match_id").withColumns({n: _rate(in_deviations if scaled else gap) for n, scaled in names.items()}).drop("_median", "_sd")


def lobby_relative(df: DataFrame, value: str = "damage_dealt", scaled: bool = True, name: str = "performance_vs_lobby") -> DataFrame:
    """F7, W7 as one column."""
    return lobby_features(df, {name: scaled}, value)


def speed_anomaly(df: DataFrame) -> DataFrame:
    """far on foot in short time; a flag, not a rejection."""
    return df.withColumn("speed_anomaly", F.coalesce((F.col("walk_distance") > 10_000) & (F.col("survival_duration") < 100), F.lit(False)))


def extreme_outliers(df: DataFrame) -> DataFrame:
    """players with over 85 % headshots in ten kills or more."""
    ratio = F.try_divide(F.col("headshot_kills").cast("double"), F.greatest(F.col("kills"), F.lit(1)).cast("double"))
    return df.agg(F.count_if((ratio > 0.85) & (F.col("kills") >= 10)).alias("extreme_outlier_count"), F.count("*").alias("total_rows"))
