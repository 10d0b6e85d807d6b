"""Data-quality invariants as a table of violations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S

SYNTHETIC_COLUMNS = {"is_synthetic", "mock_id"}
SYNTHETIC_NAMES = "player_suspect_|player_alpha_"


def duplicate_keys(pm: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """All rows of keys that occur more than once, counted by key."""
    keys = keys or ["match_id", "player_id"]
    return pm.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def _row(name: str, df: DataFrame) -> DataFrame:
    return df.select(F.lit(name).alias("invariant"), F.col("found").cast("bigint").alias("violations"))


def verify_invariants(bronze: DataFrame, kills: DataFrame, pm: DataFrame, gold: DataFrame, allow_empty: bool = False, identity: str = "canonical") -> DataFrame:
    """``invariant, violations`` of every rule; 0 is good."""
    checks = []
    for name, df in (("I1_bronze_not_empty", bronze), ("I2_kill_events_not_empty", kills), ("I3_player_match_not_empty", pm), ("I4_gold_not_empty", gold)):
        empty = F.when(F.count("*") == 0, 0 if allow_empty else 1).otherwise(0)
        checks.append(_row(name, df.agg(empty.alias("found"))))
    source = bronze if identity == "reference" else bronze.where((F.col("op") == S.OP_KILL_RAW) & (F.length("killer_name") > 0))
    both = source.select(F.lit(1).alias("n")).unionAll(kills.select(F.lit(-1).alias("n")))
    checks.append(_row("I5_kill_rows_equal_bronze", both.agg(F.abs(F.coalesce(F.sum("n"), F.lit(0))).alias("found"))))
    checks.append(_row("I6_no_duplicate_player_match", duplicate_keys(pm).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("found"))))
    for name, df, cols in (("I7_no_synthetic_kill_rows", kills, ["killer_name", "victim_name"]), ("I7_no_synthetic_player_rows", pm, ["player_id"])):
        marked = F.lit(bool(SYNTHETIC_COLUMNS & set(df.columns)))
        named = reduce(lambda a, b: a | b, [F.coalesce(F.col(c).rlike(SYNTHETIC_NAMES), F.lit(False)) for c in cols])
        checks.append(_row(name, df.agg(F.count_if(marked | named).alias("found"))))
    return reduce(DataFrame.unionByName, checks)
