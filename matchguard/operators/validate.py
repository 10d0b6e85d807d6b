"""Validation with every failed rule recorded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.expr import INF, blank, failed, failed_codes, finite, is_hex64, is_rfc3339, reasons, trimmed

Rule = tuple[Column, str]


def common_rules() -> list[Rule]:
    out: list[Rule] = [(blank("event_id"), "event_id_blank"), (~is_hex64("event_id") & ~blank("event_id"), "event_id_not_sha256")]
    for c in ("match_id", "player_id"):
        out += [(blank(c), f"{c}_blank"), ((F.octet_length(c) > 256) & (F.octet_length(trimmed(c)) > 256), f"{c}_too_long")]
    return [*out, (~F.col("schema_version").eqNullSafe("1.0"), "schema_version_unknown"), (~is_rfc3339("ingest_time"), "ingest_time_invalid"), (F.col("event_time").isNotNull() & ~is_rfc3339("event_time"), "event_time_invalid")]


def _metric(c: str) -> Column:
    return F.col(c).isNull() | ~finite(c) | (F.col(c) < 0)


def player_stat_rules(prefix: str = "") -> list[Rule]:
    """P12 on columns named ``prefix`` + metric; needs ``op``."""
    p = lambda c: f"{prefix}{c}"
    win = p("win_place_perc")
    return [
        (~F.col("op").isin(S.OP_MATCH_SUMMARY, S.OP_KILL_DEATH), "op_not_player_stat"),
        (F.col(p("kills")) < 0, "kills_negative"),
        (F.col(p("headshot_kills")) < 0, "headshot_kills_negative"),
        (F.col(p("headshot_kills")) > F.col(p("kills")), "headshot_kills_over_kills"),
        *((_metric(p(c)), f"{c}_invalid") for c in ("damage_dealt", "walk_distance", "ride_distance", "swim_distance", "survival_duration")),
        (F.col(win).isNotNull() & (~finite(win) | (F.col(win) < 0) | (F.col(win) > 1)), "win_place_perc_out_of_range"),
    ]


def kill_event_rules(prefix: str = "") -> list[Rule]:
    """P13 on columns named ``prefix`` + field; needs ``op`` and ``match_id``."""
    p = lambda c: F.col(f"{prefix}{c}")
    out: list[Rule] = [(~F.col("op").eqNullSafe(S.OP_KILL_RAW), "op_not_kill_event")]
    if prefix:
        out.append((~p("match_id").eqNullSafe(F.col("match_id")), "match_id_mismatch"))
    out += [(p(c) <= 0, f"{c}_not_positive") for c in ("killer_placement", "victim_placement")]
    out += [(~finite(p(c)), f"{c}_not_finite") for c in ("killer_position_x", "killer_position_y", "victim_position_x", "victim_position_y", "event_time_seconds")]
    return [*out, (p("event_time_seconds") < 0, "event_time_seconds_negative")]


def validate_common(df: DataFrame) -> DataFrame:
    return df.withColumn("reasons", reasons(*common_rules()))


def validate_player_stat(df: DataFrame, prefix: str = "") -> DataFrame:
    return df.withColumn("reasons", reasons(*player_stat_rules(prefix)))


def validate_kill_event(df: DataFrame, prefix: str = "") -> DataFrame:
    return df.withColumn("reasons", reasons(*kill_event_rules(prefix)))


def validate_events(envelopes: DataFrame) -> DataFrame:
    """All reasons of each envelope, common ones first, then those of its kind."""
    # generators of one row: conditions on the reasons stay above them, so an envelope is made and judged once and not once a use of a field;
    # bits first, so codes are listed only for rows that fail a rule; each step is a method of its own, small enough for the JVM to compile
    common, stat, kill = common_rules(), player_stat_rules("stat."), kill_event_rules("kill.")
    own = F.when(F.col("kind") == "kill", failed(kill, len(common) + len(stat))).otherwise(failed(stat, len(common)))
    judged = envelopes.withColumn("_common", failed(common))
    judged = judged.select("*", F.inline(F.array(F.struct(F.col("_common").bitwiseOR(own).alias("_failed")))))
    codes = failed_codes("_failed", [code for _, code in (*common, *stat, *kill)])
    return judged.select(*envelopes.columns, F.inline(F.array(F.struct(codes.alias("reasons")))))


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.where(F.size("reasons") == 0).drop("reasons"), df.where(F.size("reasons") > 0)


def invalid_envelopes(df: DataFrame) -> DataFrame:
    return df.where(F.size("reasons") > 0).select("event_id", "match_id", "player_id", "reasons")


def validate_gold_signal(df: DataFrame, scheme: str = "s3://") -> DataFrame:
    """Signals for training; hashes in lower case only, artifacts in a store of ``scheme``."""
    low = lambda c: F.coalesce(F.col(c).rlike("^[0-9a-f]{64}$"), F.lit(False))
    return df.withColumn("reasons", reasons(
        (~F.col("schema_version").eqNullSafe("1.0"), "schema_version_unknown"), (~F.col("op").eqNullSafe(S.OP_GOLD_READY), "op_not_gold_ready"), (~low("event_id"), "event_id_not_sha256"),
        (~low("checksum_sha256"), "checksum_not_sha256"), (~F.coalesce(F.col("object_uri").startswith(scheme), F.lit(False)), "object_uri_not_s3"),
    ))


def finite_features(df: DataFrame, cols: list[str] | None = None, minimum: int = 20, impute: float | None = None) -> DataFrame:
    """Infinite and NaN values are null; rows with a null go (or get ``impute``); too few rows are an error."""
    cols = S.FEATURES if cols is None else cols
    out = df.withColumns({c: F.when(finite(F.col(c).cast("double")), F.col(c).cast("double")) for c in cols})
    out = out.fillna(impute, cols) if impute is not None else out.dropna(subset=cols)
    if minimum and out.limit(minimum).count() < minimum:
        raise ValueError(f"fewer than {minimum} complete rows")
    return out


def labeled_rows(df: DataFrame, label: str = "is_suspicious", cols: list[str] | None = None) -> DataFrame:
    """Complete labelled rows; at least two matches and both classes."""
    out = finite_features(df, cols, minimum=0).dropna(subset=[label, "match_id"])
    seen = out.agg(F.count_distinct("match_id").alias("m"), F.count_distinct(F.col(label).cast("int")).alias("c")).head()
    if seen["m"] < 2 or seen["c"] < 2:
        raise ValueError("supervised training needs two matches and both classes")
    return out


def scoring_error(n_features: int) -> Column:
    """P20: why a scoring request cannot be served, or null. Needs op, match_id, player_id, features."""
    blank = lambda c: (trimmed(c) == "") | (F.octet_length(trimmed(c)) > 256)
    bad = F.exists("features", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= F.lit(INF)))
    return (
        F.when(~F.col("op").eqNullSafe("predict"), "op_not_predict").when(blank("match_id"), "match_id_invalid").when(blank("player_id"), "player_id_invalid")
        .when(F.col("features").isNull() | (F.size("features") != n_features), "feature_count_mismatch").when(bad, "features_not_finite")
    )
