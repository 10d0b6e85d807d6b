"""Silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.expr import finite_or_null, sha256


def canonical_identity(bronze: DataFrame) -> DataFrame:
    """Kill rows name killer and victim by the same hash as ``player_id`` (defect X1)."""
    is_kill = F.col("op") == S.OP_KILL_RAW
    hashed = lambda c: F.when(is_kill & (F.length(c) > 0) & ~F.col(c).rlike("^[0-9a-f]{64}$"), sha256(c)).otherwise(F.col(c))
    return bronze.withColumns({c: hashed(c) for c in ("killer_name", "victim_name")})


def to_silver_kill_events(bronze: DataFrame, identity: str = "canonical") -> DataFrame:
    """P16. The reference keeps every bronze row and names a missing killer by the player;
    canonical keeps kill rows that have a killer (defects X2, X3)."""
    names = [f.name for f in S.SILVER_KILL_EVENTS.fields]
    if identity == "reference":
        return bronze.withColumn("killer_name", F.coalesce("killer_name", "player_id")).select(*names)
    return bronze.where((F.col("op") == S.OP_KILL_RAW) & (F.length("killer_name") > 0)).select(*names)


def player_match(bronze: DataFrame, identity: str = "canonical") -> DataFrame:
    """Greatest value of each metric by (match, player), at least 0; killers and victims are there with zeros.

    One group-by over stat rows and participants together. NaN never wins a maximum.
    """
    metrics = [F.col(c).cast("double" if c not in ("kills", "headshot_kills") else "bigint").alias(c) for c in S.METRICS]
    own = bronze.select("match_id", "player_id", *metrics)
    empty = {c: F.lit(None) for c in S.METRICS}
    people = bronze if identity == "reference" else bronze.where(F.col("op") == S.OP_KILL_RAW)
    names = F.explode(F.array("victim_name") if identity == "reference" else F.array("killer_name", "victim_name"))
    rows = own.unionByName(people.select("match_id", names.alias("player_id"), *(v.cast("double" if c not in ("kills", "headshot_kills") else "bigint").alias(c) for c, v in empty.items())))
    if identity != "reference":  # a kill row's player id repeats its killer or victim
        rows = rows.where(F.length("player_id") > 0)
    zero = lambda c: F.lit(0).cast("bigint") if c in ("kills", "headshot_kills") else F.lit(0.0)
    best = lambda c: F.greatest(zero(c), F.coalesce(F.max(F.col(c) if c in ("kills", "headshot_kills") else F.nanvl(c, F.lit(None).cast("double"))), zero(c))).alias(c)
    return rows.where((F.length("match_id") > 0) & (F.length("player_id") > 0)).groupBy("match_id", "player_id").agg(*(best(c) for c in S.METRICS))


def participants(kills: DataFrame) -> DataFrame:
    """U2 alone: everyone who kills or is killed in a match, once."""
    both = kills.select("match_id", F.explode(F.array("killer_name", "victim_name")).alias("player_id"))
    return both.where((F.length("match_id") > 0) & (F.length("player_id") > 0)).distinct()


def players(player_match: DataFrame) -> DataFrame:
    """profile of a player over all matches."""
    return player_match.groupBy("player_id").agg(
        F.count_distinct("match_id").alias("matches"), F.sum("kills").alias("total_kills"), F.sum("headshot_kills").alias("total_headshot_kills"), F.max("kills").alias("max_kills"),
        F.avg(finite_or_null("damage_dealt")).alias("mean_damage"), F.max("damage_dealt").alias("max_damage"), F.avg(finite_or_null("survival_duration")).alias("mean_survival"),
    )


def matches(player_match: DataFrame) -> DataFrame:
    """summary of a match."""
    return player_match.groupBy("match_id").agg(
        F.count("*").alias("players"), F.sum("kills").alias("total_kills"), F.expr("percentile(damage_dealt, 0.5)").alias("median_damage"),
        F.stddev_samp("damage_dealt").alias("sd_damage"), F.max("survival_duration").alias("duration"),
    )
