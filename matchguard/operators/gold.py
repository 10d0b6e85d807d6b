"""The gold feature matrix.

Kill features take one shuffle: intervals (a window by match and killer) and the
aggregates share its partitioning; distinct weapons are a set aggregate, so rows
are not expanded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.expr import distance

KEYS = ["match_id", "killer_name"]


def kill_intervals(kills: DataFrame) -> DataFrame:
    """Adds ``interval``, the time since the killer's kill before; null for first and untimed kills."""
    timed = Window.partitionBy(*KEYS, F.col("event_time_seconds").isNull()).orderBy("event_time_seconds")
    gap = F.col("event_time_seconds") - F.lag("event_time_seconds").over(timed)
    return kills.withColumn("interval", gap)


def kill_features(kills: DataFrame, short_interval_threshold: float = 10.0) -> DataFrame:
    """A2-A6 by (match, killer)."""
    # rows are dealt by the group's keys once; window and aggregate both keep that
    dealt = kills.select(*KEYS, "event_time_seconds", "weapon", distance("killer_position_x", "killer_position_y", "victim_position_x", "victim_position_y").alias("distance")).repartition(*KEYS)
    return kill_intervals(dealt).groupBy(*KEYS).agg(
        F.count("*").alias("kill_count"),
        F.min("interval").alias("minimum_kill_interval_seconds"),
        F.percentile("distance", F.lit(0.5)).alias("median_kill_distance_coordinate_units"),
        F.count_if(F.col("interval") <= short_interval_threshold).alias("short_kill_interval_count"),
        F.size(F.collect_set(F.nullif("weapon", F.lit("")))).cast("bigint").alias("unique_weapons_used"),
    )


def gold_features(player_match: DataFrame, kills: DataFrame, short_interval_threshold: float = 10.0, created_at: Column | None = None) -> DataFrame:
    """Every player of every match, with kill features where the player killed."""
    f = kill_features(kills, short_interval_threshold).withColumnRenamed("killer_name", "player_id")
    joined = player_match.join(f, ["match_id", "player_id"], "left")
    out = joined.select(
        "match_id", "player_id", F.coalesce("kill_count", "kills", F.lit(0)).cast("bigint").alias("kills"), "minimum_kill_interval_seconds", "median_kill_distance_coordinate_units",
        *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("short_kill_interval_count", "unique_weapons_used")),
    )
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX") if created_at is None else created_at
    return out.withColumn("feature_version", F.lit(S.FEATURE_VERSION)).withColumn("created_at", now)
