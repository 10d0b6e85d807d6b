"""Queries over the given tables, one for each operator, and the same in DuckDB's SQL.

Sums and means of doubles are rounded, as their last digits depend on order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.expr import distance, one_decimal
from ..operators import bronze as B
from ..operators import boosting, decision, dedup, envelope, evidence, features, gold, ml, normalize, quality, reports, scoring, silver, validate
from ..sources import lake, readers
from ..sources.folders import scratch, shuffles_removed
from ..streaming import pipeline
from . import adapters as A

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
SHORT = 3600.0  # a day is a match here, so a short interval is an hour


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return add


WITH_KILLS = f"WITH k AS ({A.KILLS})"
WITH_STATS = f"WITH s AS ({A.STATS})"
_DIST = "sqrt((killer_position_x - victim_position_x) * (killer_position_x - victim_position_x) + (killer_position_y - victim_position_y) * (killer_position_y - victim_position_y))"
_FEATS = f"""g AS (SELECT *, event_time_seconds - lag(event_time_seconds) OVER (PARTITION BY match_id, killer_name ORDER BY event_time_seconds) AS dt, {_DIST} AS d FROM k),
f AS (SELECT match_id, killer_name, count(*) AS kill_count, min(dt) AS minimum_kill_interval_seconds, quantile_cont(d, 0.5) AS median_kill_distance_coordinate_units,
      count(*) FILTER (WHERE dt <= 3600) AS short_kill_interval_count, count(DISTINCT nullif(weapon, '')) AS unique_weapons_used FROM g GROUP BY 1, 2)"""
_PEOPLE = "p AS (SELECT match_id, killer_name AS player_id FROM k UNION SELECT match_id, victim_name FROM k)"
_GOLD = f"""{WITH_KILLS}, {_FEATS}, {_PEOPLE}, gold AS (SELECT p.match_id, p.player_id, coalesce(kill_count, 0) AS kills, minimum_kill_interval_seconds, median_kill_distance_coordinate_units,
  coalesce(short_kill_interval_count, 0) AS short_kill_interval_count, coalesce(unique_weapons_used, 0) AS unique_weapons_used
  FROM p LEFT JOIN f ON p.match_id = f.match_id AND p.player_id = f.killer_name)"""


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = A.kills(spark, sf_dir)
    pm = silver.participants(k).withColumn("kills", F.lit(0).cast("bigint"))
    return gold.gold_features(pm, k, SHORT).drop("feature_version", "created_at")


def _written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """The rows as a table of their own, for what reads them more than once."""
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


@query(f"{_GOLD} SELECT * FROM gold")
def gold_features(spark, sf_dir):
    """Silver participants joined with kill features: the flagship."""
    return _gold(spark, sf_dir)


_BRONZE_SQL = f"""{WITH_KILLS}, s AS ({A.STATS}), b AS (
  SELECT match_id, sha256(killer_name) AS player_id, killer_name, victim_name, event_time_seconds, killer_position_x, killer_position_y, victim_position_x, victim_position_y, weapon,
         NULL::BIGINT AS kills, NULL::BIGINT AS headshot_kills, NULL::DOUBLE AS damage_dealt, NULL::DOUBLE AS walk_distance, NULL::DOUBLE AS ride_distance, NULL::DOUBLE AS swim_distance,
         NULL::DOUBLE AS survival_duration, NULL::DOUBLE AS win_place_perc, 'data.kill_event.raw' AS op FROM k
  UNION ALL SELECT match_id, player_id, player_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, kills, headshot_kills, damage_dealt, walk_distance, ride_distance, swim_distance,
         survival_duration, win_place_perc, 'data.player_stat.match_summary' FROM s)"""
_BEST = ", ".join(f"greatest(0, coalesce(max({c}), 0)) AS {c}" for c in S.METRICS)


@query(f"""{_BRONZE_SQL}, kk AS (SELECT match_id, coalesce(killer_name, player_id) AS killer_name, event_time_seconds, weapon, {_DIST} AS d FROM b),
g AS (SELECT *, CASE WHEN event_time_seconds IS NOT NULL THEN event_time_seconds - lag(event_time_seconds) OVER (PARTITION BY match_id, killer_name, event_time_seconds IS NULL ORDER BY event_time_seconds) END AS dt FROM kk),
f AS (SELECT match_id, killer_name, count(*) AS kill_count, min(dt) AS a, quantile_cont(d, 0.5) AS m, count(*) FILTER (WHERE dt <= 3600) AS c, count(DISTINCT nullif(weapon, '')) AS w FROM g GROUP BY 1, 2),
pm AS (SELECT match_id, player_id, greatest(0, coalesce(max(kills), 0)) AS kills FROM (SELECT match_id, player_id, kills FROM b UNION ALL SELECT match_id, victim_name, NULL FROM b) WHERE length(match_id) > 0 AND length(player_id) > 0 GROUP BY 1, 2)
SELECT pm.match_id, pm.player_id, coalesce(kill_count, kills, 0) AS kills, a AS minimum_kill_interval_seconds, m AS median_kill_distance_coordinate_units,
  coalesce(c, 0) AS short_kill_interval_count, coalesce(w, 0) AS unique_weapons_used FROM pm LEFT JOIN f ON pm.match_id = f.match_id AND pm.player_id = f.killer_name""")
def gold_features_reference_identity(spark, sf_dir):
    """Both sources through bronze and silver with the reference's own identities."""
    b = A.bronze(spark, sf_dir)
    return gold.gold_features(silver.player_match(b, "reference"), silver.to_silver_kill_events(b, "reference"), SHORT).drop("feature_version", "created_at")


@query(f"""{WITH_KILLS}, s AS ({A.STATS}), r AS (SELECT match_id, player_id, kills, headshot_kills, damage_dealt, walk_distance, ride_distance, swim_distance, survival_duration, win_place_perc FROM s
  UNION ALL SELECT match_id, unnest([sha256(killer_name), sha256(victim_name)]), NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM k)
SELECT match_id, player_id, {_BEST} FROM r GROUP BY 1, 2""")
def player_match(spark, sf_dir):
    return silver.player_match(silver.canonical_identity(A.bronze(spark, sf_dir)))


@query(f"{WITH_KILLS}, {_PEOPLE} SELECT * FROM p")
def participants(spark, sf_dir):
    return silver.participants(A.kills(spark, sf_dir))


@query(f"{WITH_KILLS} SELECT row_id, match_id, killer_name, event_time_seconds - lag(event_time_seconds) OVER (PARTITION BY match_id, killer_name ORDER BY event_time_seconds) AS interval FROM k QUALIFY interval IS NOT NULL")
def kill_intervals(spark, sf_dir):
    return gold.kill_intervals(A.kills(spark, sf_dir)).where("interval is not null").select("row_id", "match_id", "killer_name", "interval")


@query(f"{WITH_KILLS}, {_FEATS} SELECT match_id, killer_name, short_kill_interval_count, minimum_kill_interval_seconds FROM f")
def short_intervals(spark, sf_dir):
    return gold.kill_features(A.kills(spark, sf_dir), SHORT).select("match_id", "killer_name", "short_kill_interval_count", "minimum_kill_interval_seconds")


@query(f"{WITH_KILLS}, {_FEATS} SELECT match_id, killer_name, median_kill_distance_coordinate_units FROM f")
def median_kill_distance(spark, sf_dir):
    return gold.kill_features(A.kills(spark, sf_dir), SHORT).select("match_id", "killer_name", "median_kill_distance_coordinate_units")


@query(f"{WITH_KILLS}, {_FEATS} SELECT match_id, killer_name, unique_weapons_used, kill_count FROM f")
def unique_weapons(spark, sf_dir):
    return gold.kill_features(A.kills(spark, sf_dir), SHORT).select("match_id", "killer_name", "unique_weapons_used", "kill_count")


_ORDER = ["l_partkey", "l_quantity", "l_extendedprice", "l_suppkey"]


@query(f"{WITH_STATS} SELECT event_id, match_id, player_id, kills, damage_dealt FROM s QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY {', '.join(_ORDER)}) = 1")
def dedup_events(spark, sf_dir):
    return dedup.dedup_events(A.stats(spark, sf_dir), _ORDER).select("event_id", "match_id", "player_id", "kills", "damage_dealt")


@query(f"""{WITH_STATS}, b AS (SELECT * REPLACE (CASE WHEN l_linenumber = 7 THEN '' ELSE event_id END AS event_id) FROM s)
SELECT event_id, match_id, player_id, kills, damage_dealt FROM b QUALIFY event_id = '' OR row_number() OVER (PARTITION BY event_id ORDER BY {', '.join(_ORDER)}) = 1""")
def dedup_bronze(spark, sf_dir):
    s = A.stats(spark, sf_dir).withColumn("event_id", F.when(F.col("l_linenumber") == 7, "").otherwise(F.col("event_id")))
    return dedup.dedup_bronze(s, _ORDER).select("event_id", "match_id", "player_id", "kills", "damage_dealt")


@query(f"{WITH_STATS} SELECT count(*) - count(DISTINCT event_id) AS duplicate_records FROM s")
def duplicate_count(spark, sf_dir):
    return dedup.duplicate_count(A.stats(spark, sf_dir))


def _reason_rows(df: DataFrame) -> DataFrame:
    return df.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("records"))


def _checked_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.validate_player_stat(A.stats(spark, sf_dir).withColumn("op", F.lit(S.OP_MATCH_SUMMARY)))


_BAD_STAT = "SELECT 'headshot_kills_over_kills' AS reason FROM s WHERE headshot_kills > kills UNION ALL SELECT 'win_place_perc_out_of_range' FROM s WHERE win_place_perc > 1 OR win_place_perc < 0"


@query(f"{WITH_STATS} SELECT reason, count(*) AS records FROM ({_BAD_STAT}) GROUP BY 1")
def validate_player_stat_reasons(spark, sf_dir):
    return _reason_rows(_checked_stats(spark, sf_dir))


@query(f"""{WITH_KILLS} SELECT reason, count(*) AS records FROM (SELECT 'killer_placement_not_positive' AS reason FROM k WHERE killer_placement <= 0
UNION ALL SELECT 'victim_placement_not_positive' FROM k WHERE victim_placement <= 0) GROUP BY 1""")
def validate_kill_event_reasons(spark, sf_dir):
    return _reason_rows(validate.validate_kill_event(A.kills(spark, sf_dir).withColumn("op", F.lit(S.OP_KILL_RAW))))


@query(f"{WITH_STATS} SELECT count(*) FILTER (WHERE NOT bad) AS valid, count(*) FILTER (WHERE bad) AS invalid FROM (SELECT headshot_kills > kills OR win_place_perc > 1 OR win_place_perc < 0 AS bad FROM s)")
def valid_invalid_split(spark, sf_dir):
    good, bad = validate.split(_checked_stats(spark, sf_dir))
    return good.select(F.lit(1).alias("v"), F.lit(0).alias("i")).unionAll(bad.select(F.lit(0), F.lit(1))).agg(F.sum("v").alias("valid"), F.sum("i").alias("invalid"))


@query(f"""{WITH_STATS}, r AS ({_BAD_STAT}), t AS (SELECT count(*) AS n FROM s WHERE headshot_kills > kills OR win_place_perc > 1 OR win_place_perc < 0)
SELECT reason, count(*) AS records, round(count(*) * 100.0::DOUBLE / any_value(n), 6) AS percent FROM r, t GROUP BY 1""")
def invalid_reason_breakdown(spark, sf_dir):
    bad = validate.split(_checked_stats(spark, sf_dir))[1]
    return reports.invalid_reason_breakdown(bad).withColumn("percent", F.round(F.col("percent").cast("double"), 6))


@query(f"{_BRONZE_SQL} SELECT op, count(*) AS n, count(killer_name) AS killers, count(victim_name) AS victims, count(kills) AS with_metrics, sum(kills) AS kills FROM b GROUP BY 1")
def bronze_union(spark, sf_dir):
    return A.bronze(spark, sf_dir).groupBy("op").agg(F.count("*").alias("n"), F.count("killer_name").alias("killers"), F.count("victim_name").alias("victims"), F.count("kills").alias("with_metrics"), F.sum("kills").alias("kills"))


def _raw_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as the raw CSV of player statistics: strings, some of them bad."""
    li = A.table(spark, sf_dir, "lineitem")
    s = lambda c: F.col(c).cast("string")
    return li.select(
        F.when(F.col("l_suppkey") % 89 != 0, F.concat(F.lit("s"), s("l_suppkey"))).otherwise("").alias("Id"), F.concat(F.lit("m"), (F.col("l_orderkey") % 100).cast("string")).alias("matchId"),
        F.when(F.col("l_linenumber") == 6, "x7").otherwise(F.col("l_quantity").cast("bigint").cast("string")).alias("kills"), ((F.col("l_linenumber") * F.col("l_suppkey")) % 12).cast("string").alias("headshotKills"),
        (F.col("l_partkey") - 50).cast("string").alias("walkDistance"), F.lit(" 12.5 ").alias("damageDealt"), F.lit("").alias("rideDistance"), F.lit("0").alias("swimDistance"), F.lit("900").alias("matchDuration"), F.lit("").alias("winPlacePerc"),
        F.lit("lineitem.csv").alias("source_file"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("record_index"),
    )


_RAW_STATS = """r AS (SELECT CASE WHEN l_suppkey % 89 <> 0 THEN 's' || l_suppkey ELSE '' END AS player, 'm' || (l_orderkey % 100) AS match, l_linenumber = 6 AS bad_kills, CASE WHEN l_linenumber = 6 THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS kills,
  (l_linenumber * l_suppkey) % 12 AS heads, l_partkey - 50 AS walk, l_orderkey * 10 + l_linenumber AS record_index FROM lineitem)"""


@query(f"""WITH {_RAW_STATS} SELECT reason, count(*) AS records FROM (SELECT 'player_id_blank' AS reason FROM r WHERE player = '' UNION ALL SELECT 'kills_invalid' FROM r WHERE bad_kills
UNION ALL SELECT 'headshot_kills_over_kills' FROM r WHERE heads > kills UNION ALL SELECT 'walk_distance_negative' FROM r WHERE walk < 0) GROUP BY 1""")
def normalize_errors(spark, sf_dir):
    n = normalize.normalize(_raw_stats(spark, sf_dir), "lineitem")
    return n.select(F.explode("errors").alias("reason")).groupBy("reason").agg(F.count("*").alias("records"))


@query(f"""WITH {_RAW_STATS} SELECT record_index, sha256('lineitem.csv:' || match || ':' || record_index || ':' || player) AS event_id, sha256(match) AS match_id, sha256(player) AS player_id, kills, CAST(walk AS DOUBLE) AS walk_distance, 12.5::DOUBLE AS damage_dealt
FROM r WHERE NOT (player = '' OR bad_kills OR heads > kills OR walk < 0)""")
def event_ids(spark, sf_dir):
    good, _ = normalize.split_valid_invalid(normalize.normalize(_raw_stats(spark, sf_dir), "lineitem"))
    return good.select("source.record_index", "event_id", "match_id", "player_id", "payload.kills", "payload.walk_distance", "payload.damage_dealt")


@query("SELECT event_id AS row_id, sha256('u' || user_id) AS player_id, sha256(CAST(CAST(ts AS DATE) AS VARCHAR)) AS match_id, sha256('events.csv:' || CAST(CAST(ts AS DATE) AS VARCHAR) || ':' || event_id || ':u' || user_id || ':u' || ((event_id * 7 + 3) % 150)) AS event_id FROM events")
def pseudonyms(spark, sf_dir):
    k = A.kills(spark, sf_dir)
    raw = k.select("match_id", "killer_name", "victim_name", F.col("event_time_seconds").cast("string").alias("time"), F.col("weapon").alias("killed_by"), F.lit("events.csv").alias("source_file"), F.col("row_id").alias("record_index"))
    return normalize.normalize(raw, "events").select(F.col("source.record_index").alias("row_id"), "player_id", "match_id", "event_id")


@query(f"WITH {_RAW_STATS} SELECT count(*) AS records_read, count(*) FILTER (WHERE NOT bad) AS records_valid, count(*) FILTER (WHERE bad) AS records_invalid, count(*) FILTER (WHERE NOT bad) AS records_produced FROM (SELECT player = '' OR bad_kills OR heads > kills OR walk < 0 AS bad FROM r)")
def replay_statistics(spark, sf_dir):
    return normalize.replay_statistics(normalize.normalize(_raw_stats(spark, sf_dir), "lineitem"))


@query("SELECT CASE WHEN event_id % 11 = 0 THEN 'malformed' ELSE 'kill' END AS kind, count(*) AS n, count(DISTINCT CASE WHEN event_id % 11 <> 0 THEN user_id END) AS players FROM events GROUP BY 1")
def parse_envelopes(spark, sf_dir):
    """Kill envelopes written as topic messages, every eleventh with a wrong type, parsed again."""
    k = A.kills(spark, sf_dir)
    raw = k.select("match_id", "killer_name", "victim_name", F.col("event_time_seconds").cast("string").alias("time"), F.col("weapon").alias("killed_by"), F.lit("events.csv").alias("source_file"), F.col("row_id").alias("record_index"))
    env = normalize.normalize(raw, "events", F.lit("2026-01-01T00:00:00Z")).drop("errors", "raw_fields")
    value = F.to_json(F.struct("*"))
    broken = F.when(F.col("source.record_index") % 11 == 0, F.regexp_replace(value, '"record_index":\\d+', '"record_index":"no"')).otherwise(value)
    sent = env.select(broken.cast("binary").alias("value"), F.lit("raw").alias("topic"), F.lit(0).alias("partition"), F.col("source.record_index").alias("offset"))
    return envelope.parse_envelopes(sent).groupBy("kind").agg(F.count("*").alias("n"), F.count_distinct("kill.player_id").alias("players"))


_MIN = "(CASE WHEN survival_duration = 0 THEN 1.0::DOUBLE ELSE survival_duration END / 60)"
_RATES = f"""SELECT event_id, match_id, player_id, kills / {_MIN} AS kills_per_minute, damage_dealt / {_MIN} AS damage_per_minute, CASE WHEN kills = 0 THEN 0 ELSE CAST(headshot_kills AS DOUBLE) / greatest(kills, 1) END AS headshot_ratio,
  walk_distance + ride_distance + swim_distance AS total_distance, damage_dealt / greatest(kills, 1) AS damage_per_kill, (walk_distance + ride_distance + swim_distance) / {_MIN} AS movement_per_minute, damage_dealt, kills, l_orderkey, l_linenumber, l_partkey FROM s"""
RATE_NAMES = ["kills_per_minute", "damage_per_minute", "headshot_ratio", "total_distance", "damage_per_kill", "movement_per_minute"]
_R9 = ", ".join(RATE_NAMES)


@query(f"{WITH_STATS}, x AS ({_RATES}) SELECT event_id, player_id, l_partkey, {_R9} FROM x")
def rate_features(spark, sf_dir):
    return features.rate_features(A.stats(spark, sf_dir)).select("event_id", "player_id", "l_partkey", *RATE_NAMES)


@query(f"""{WITH_KILLS} SELECT row_id, match_id, killer_name AS player_id, 1::BIGINT AS kills, round(sqrt(killer_position_x * killer_position_x + killer_position_y * killer_position_y) / 1000, 9) AS walk_distance,
event_time_seconds AS survival_duration, CASE WHEN killer_placement <> 0 THEN 1.0::DOUBLE / killer_placement END AS win_place_perc FROM k""")
def kill_death_stats(spark, sf_dir):
    k = A.kills(spark, sf_dir)
    out = normalize.kill_death_stats(k.withColumn("match_id", F.concat_ws("|", "match_id", "row_id")))
    parts = F.split("match_id", r"\|")
    return out.select(parts[1].cast("bigint").alias("row_id"), parts[0].alias("match_id"), "player_id", "kills", F.round("walk_distance", 9).alias("walk_distance"), "survival_duration", "win_place_perc")


_PM = f"{WITH_STATS}, pm AS (SELECT match_id, player_id, {_BEST} FROM s GROUP BY 1, 2)"


def _pm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Player-match rows of the stats alone."""
    b = A.bronze(spark, sf_dir).where(F.col("op") == S.OP_MATCH_SUMMARY)
    return silver.player_match(b)


@query(f"""{_PM} SELECT player_id, count(DISTINCT match_id) AS matches, sum(kills) AS total_kills, sum(headshot_kills) AS total_headshot_kills, max(kills) AS max_kills, round(avg(damage_dealt), 4) AS mean_damage,
max(damage_dealt) AS max_damage, round(avg(survival_duration), 4) AS mean_survival FROM pm GROUP BY 1""")
def players(spark, sf_dir):
    return silver.players(_pm(spark, sf_dir)).withColumns({c: F.round(c, 4) for c in ("mean_damage", "mean_survival")})


@query(f"{_PM} SELECT match_id, count(*) AS players, sum(kills) AS total_kills, round(quantile_cont(damage_dealt, 0.5), 4) AS median_damage, round(stddev_samp(damage_dealt), 4) AS sd_damage, max(survival_duration) AS duration FROM pm GROUP BY 1")
def matches(spark, sf_dir):
    return silver.matches(_pm(spark, sf_dir)).withColumns({c: F.round(c, 4) for c in ("median_damage", "sd_damage")})


@query(f"""{_PM}, l AS (SELECT match_id, quantile_cont(damage_dealt, 0.5) AS m, stddev_samp(damage_dealt) AS sd FROM pm GROUP BY 1)
SELECT match_id, player_id, round(coalesce((damage_dealt - m) / nullif(sd, 0), 0), 5) AS performance_vs_lobby, round(damage_dealt - m, 4) AS damage_minus_median FROM pm JOIN l USING (match_id)""")
def lobby_performance(spark, sf_dir):
    pm = _pm(spark, sf_dir)
    both = features.lobby_features(pm, {"performance_vs_lobby": True, "damage_minus_median": False})
    return both.select("match_id", "player_id", F.round("performance_vs_lobby", 5).alias("performance_vs_lobby"), F.round("damage_minus_median", 4).alias("damage_minus_median"))


@query(f"{WITH_STATS} SELECT match_id, count(*) FILTER (WHERE walk_distance > 10000 AND survival_duration < 100) AS anomalies, count(*) AS n FROM s GROUP BY 1")
def speed_anomaly(spark, sf_dir):
    return features.speed_anomaly(A.stats(spark, sf_dir)).groupBy("match_id").agg(F.count_if("speed_anomaly").alias("anomalies"), F.count("*").alias("n"))


_DESCRIBED = ["kills", "damage_dealt", "walk_distance", "survival_duration"]


@query(WITH_STATS + " " + " UNION ALL ".join(f"SELECT '{c}' AS feature, round(avg({c}), 4) AS mean, round(quantile_cont({c}::DOUBLE, 0.5), 4) AS median, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, round(stddev_samp({c}), 4) AS sd, round(quantile_cont({c}::DOUBLE, 0.95), 4) AS p95, round(quantile_cont({c}::DOUBLE, 0.99), 4) AS p99 FROM s" for c in _DESCRIBED))
def describe_features(spark, sf_dir):
    return reports.describe_features(A.stats(spark, sf_dir), _DESCRIBED).withColumns({c: F.round(c, 4) for c in ("mean", "median", "sd", "p95", "p99")})


@query(f"{WITH_STATS} SELECT count(*) AS total_rows, count(DISTINCT player_id) AS players, count(DISTINCT match_id) AS matches FROM s")
def dataset_overview(spark, sf_dir):
    return reports.dataset_overview(A.stats(spark, sf_dir))


@query(f"{WITH_STATS} SELECT count(*) FILTER (WHERE CAST(headshot_kills AS DOUBLE) / greatest(kills, 1) > 0.85 AND kills >= 10) AS extreme_outlier_count, count(*) AS total_rows FROM s")
def extreme_outliers(spark, sf_dir):
    return features.extreme_outliers(A.stats(spark, sf_dir))


#: The evidence step in SQL, written out: rows ``x`` with ``rid`` and the named features become items ``t`` with their place ``k``.
EVIDENCE_ITEMS = """
ev AS (SELECT rid, unnest([
  {'i': 0, 'f': 'kills_per_minute', 'v': kills_per_minute::FLOAT, 'm': 0.15::FLOAT, 'd': 0.08::FLOAT}, {'i': 1, 'f': 'damage_per_minute', 'v': damage_per_minute::FLOAT, 'm': 120::FLOAT, 'd': 45::FLOAT},
  {'i': 2, 'f': 'headshot_ratio', 'v': headshot_ratio::FLOAT, 'm': 0.18::FLOAT, 'd': 0.08::FLOAT}, {'i': 3, 'f': 'damage_per_kill', 'v': damage_per_kill::FLOAT, 'm': 100::FLOAT, 'd': 30::FLOAT},
  {'i': 4, 'f': 'movement_per_minute', 'v': movement_per_minute::FLOAT, 'm': 150::FLOAT, 'd': 40::FLOAT}, {'i': 5, 'f': 'performance_versus_lobby', 'v': lobby::FLOAT, 'm': 200::FLOAT, 'd': 80::FLOAT}]) AS u FROM x),
ez AS (SELECT rid, u.i AS i, u.f AS f, u.v AS v, u.m AS m, ((u.v - u.m) / (u.d * 1.4826::FLOAT))::FLOAT AS z FROM ev),
er AS (SELECT *, (round(z * 10::FLOAT) / 10::FLOAT)::FLOAT AS rz FROM ez WHERE z > 1.5::FLOAT),
t AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY rz DESC, i) AS k FROM er QUALIFY k <= 2)"""


def _named(df: DataFrame) -> dict[str, Column]:
    columns = {n: S.EVIDENCE_COLUMNS.get(n, n) for n in S.EVIDENCE_FEATURES}
    return {n: F.col(c) for n, c in columns.items() if c in df.columns}


def _shown(items: Column, field: str = "feature") -> Column:
    if field == "z":
        return F.array_join(F.transform(items, lambda e: one_decimal(e["z_score"])), "|")
    return F.array_join(F.transform(items, lambda e: e[field]), "|")


@query(f"""{WITH_STATS}, x AS (SELECT *, NULL::DOUBLE AS lobby, row_number() OVER () AS rid FROM ({_RATES})), {EVIDENCE_ITEMS},
g AS (SELECT rid, string_agg(f, '|' ORDER BY k) AS fs, string_agg(printf('%.1f', rz::DOUBLE), '|' ORDER BY k) AS zs FROM t GROUP BY 1)
SELECT event_id, l_partkey, player_id, coalesce(fs, '') AS features, coalesce(zs, '') AS z_scores FROM x LEFT JOIN g USING (rid)""")
def evidence_top2(spark, sf_dir):
    """The two strongest items of every row, by name and rounded z."""
    r = features.rate_features(A.stats(spark, sf_dir))
    e = r.select("event_id", "l_partkey", "player_id", evidence.evidence(_named(r), reasons=False).alias("e"))
    return e.select("event_id", "l_partkey", "player_id", _shown(F.col("e")).alias("features"), _shown(F.col("e"), "z").alias("z_scores"))


@query(f"""{_PM}, l AS (SELECT match_id, quantile_cont(damage_dealt, 0.5) AS m FROM pm GROUP BY 1), d AS (SELECT match_id, any_value(m) AS m, quantile_cont(abs(damage_dealt - m), 0.5) AS mad FROM pm JOIN l USING (match_id) GROUP BY 1)
SELECT match_id, player_id, CAST(coalesce(((damage_dealt::FLOAT - m::FLOAT) / nullif(mad::FLOAT * 1.4826::FLOAT, 0))::FLOAT > 1.5, false) AS INTEGER) AS items FROM pm JOIN d USING (match_id)""")
def evidence_lobby(spark, sf_dir):
    return evidence.evidence_from_lobby(_pm(spark, sf_dir), ["damage_dealt"]).select("match_id", "player_id", F.size("evidence").alias("items"))


#: A logistic model over the gold features with round weights.
COEF, INTERCEPT = [0.05, -0.0005, -0.002, 0.25, 0.125], -0.5
_SCORE = "1.0::DOUBLE / (1.0::DOUBLE + exp(-(-0.5 + 0.05 * kills + -0.0005 * coalesce(minimum_kill_interval_seconds, 0) + -0.002 * coalesce(median_kill_distance_coordinate_units, 0) + 0.25 * short_kill_interval_count + 0.125 * unique_weapons_used)))"
_PREDS = f"{_GOLD}, pr AS (SELECT match_id, player_id, CAST({_SCORE} AS FLOAT) AS risk_score, gold.* EXCLUDE (match_id, player_id) FROM gold), lv AS (SELECT *, CASE WHEN risk_score >= 0.95 THEN 'CRITICAL' WHEN risk_score >= 0.8 THEN 'HIGH' WHEN risk_score >= 0.6 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level FROM pr)"


def _preds(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _gold(spark, sf_dir)
    cols = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in S.FEATURES]
    scored = g.withColumn("risk_score", scoring.score_logistic(COEF, INTERCEPT, cols))
    return scored.withColumn("risk_level", scoring.risk_level(F.col("risk_score"))).withColumn("model_version", F.lit("v1"))


@query(f"{_PREDS} SELECT match_id, player_id, round(risk_score::DOUBLE, 5) AS risk_score, risk_level FROM lv")
def risk_levels(spark, sf_dir):
    return _preds(spark, sf_dir).select("match_id", "player_id", F.round(F.col("risk_score").cast("double"), 5).alias("risk_score"), "risk_level")


@query("""SELECT coalesce(rule, 'none') AS policy_rule, count(*) AS n FROM (SELECT CASE WHEN l_discount * 10 > 0.8 THEN 'heuristic_teleport_hack' WHEN l_quantity >= 2 AND l_partkey > 0 AND l_partkey < 200 THEN 'heuristic_burst_aimbot'
WHEN l_linenumber >= 5 THEN 'heuristic_headshot_streak' END AS rule FROM lineitem) GROUP BY 1""")
def heuristic_decisions(spark, sf_dir):
    rule = decision.heuristic_rules(F.col("l_discount") * 10, F.col("l_quantity"), F.col("l_partkey"), F.col("l_linenumber"))
    return A.table(spark, sf_dir, "lineitem").groupBy(F.coalesce(rule["policy_rule"], F.lit("none")).alias("policy_rule")).agg(F.count("*").alias("n"))


_POLICY = "CASE WHEN risk_score < 0.3::FLOAT THEN 'auto_clear' WHEN risk_score < 0.6::FLOAT THEN 'watchlist_monitoring' WHEN risk_score < 0.85::FLOAT THEN 'escalate_human_review' WHEN short_kill_interval_count >= 3 THEN 'auto_suspend_aimbot' ELSE 'critical_permanent_ban' END"
_ACTION = "CASE policy_rule WHEN 'auto_clear' THEN 'CLEAR' WHEN 'watchlist_monitoring' THEN 'WATCHLIST' WHEN 'escalate_human_review' THEN 'ESCALATE_TO_MODERATOR' WHEN 'auto_suspend_aimbot' THEN 'SUSPEND_ACCOUNT' ELSE 'PERMANENT_BAN' END"


@query(f"{_PREDS}, d AS (SELECT match_id, player_id, {_POLICY} AS policy_rule FROM lv) SELECT match_id, player_id, policy_rule, {_ACTION} AS action FROM d")
def policy_decisions(spark, sf_dir):
    d = decision.policy_decision(F.col("risk_score"), F.col("short_kill_interval_count").cast("double"), decision.FIVE_RULES)
    return _preds(spark, sf_dir).withColumn("d", d).select("match_id", "player_id", "d.policy_rule", "d.action")


_SERVED = f"""{_PM}, l AS (SELECT match_id, quantile_cont(damage_dealt, 0.5) AS md FROM pm GROUP BY 1),
x AS (SELECT match_id || '/' || player_id AS rid, match_id, player_id, kills, headshot_kills, survival_duration, kills % 13 = 0 AS bad, kills / {_MIN} AS kills_per_minute, damage_dealt / {_MIN} AS damage_per_minute,
  CASE WHEN kills = 0 THEN 0 ELSE CAST(headshot_kills AS DOUBLE) / greatest(kills, 1) END AS headshot_ratio, damage_dealt / greatest(kills, 1) AS damage_per_kill,
  (walk_distance + ride_distance + swim_distance) / {_MIN} AS movement_per_minute, damage_dealt - md AS lobby,
  CAST(1.0::DOUBLE / (1.0::DOUBLE + exp(-(-1.5 + 0.05 * kills + 0.25 * headshot_kills + -0.0005 * survival_duration))) AS FLOAT) AS score FROM pm JOIN l USING (match_id)), {EVIDENCE_ITEMS},
g AS (SELECT rid, string_agg(f, '|' ORDER BY k) AS fs, string_agg(printf('%.1f', rz::DOUBLE), '|' ORDER BY k) AS zs, max(CASE WHEN f = 'headshot_ratio' THEN rz END) AS hz,
  string_agg(CASE WHEN rz >= 4 THEN 'high' WHEN rz >= 2 THEN 'medium' ELSE 'low' END, '|' ORDER BY k) AS sizes,
  string_agg(f || ' ' || printf('%.2f', v::DOUBLE + 1e-9) || ' against ' || printf('%.2f', m::DOUBLE + 1e-9) || ' in the lobby (+' || printf('%.1f', z::DOUBLE + 1e-9) || ' sigma)', '|' ORDER BY k) AS texts FROM t GROUP BY 1),
sv AS (SELECT x.*, coalesce(fs, '') AS fs, coalesce(zs, '') AS zs, coalesce(hz, 0) AS hz, coalesce(sizes, '') AS sizes, coalesce(texts, '') AS texts,
  CASE WHEN score >= 0.95 THEN 'CRITICAL' WHEN score >= 0.8 THEN 'HIGH' WHEN score >= 0.6 THEN 'MEDIUM' ELSE 'LOW' END AS level FROM x LEFT JOIN g USING (rid))"""


def served(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of player-match rows, some of them wrong, through scoring, evidence and policy."""
    pm = features.lobby_relative(features.rate_features(_pm(spark, sf_dir)), scaled=False)
    three = [F.col(c).cast("double") for c in ("kills", "headshot_kills", "survival_duration")]
    req = pm.withColumn("op", F.when(F.col("kills") % 13 == 0, "other").otherwise("predict")).withColumn("features", F.array(*three))
    at = [F.col("features")[i] for i in range(3)]
    return scoring.predict(req, scoring.score_logistic([0.05, 0.25, -0.0005], -1.5, at), decision.FIVE_RULES, "v1", 3, named=_named(req))


@query(f"""{_SERVED} SELECT match_id, player_id, CASE WHEN bad THEN 'UNAVAILABLE' ELSE 'OK' END AS status, CASE WHEN bad THEN 0 ELSE round(score::DOUBLE, 5) END AS risk_score, CASE WHEN NOT bad THEN level END AS risk_level,
CASE WHEN bad THEN NULL WHEN score < 0.3::FLOAT THEN 'auto_clear' WHEN score < 0.6::FLOAT THEN 'watchlist_monitoring' WHEN score < 0.85::FLOAT THEN 'escalate_human_review' WHEN hz >= 3 THEN 'auto_suspend_aimbot' ELSE 'critical_permanent_ban' END AS policy_rule,
CASE WHEN NOT bad THEN fs END AS features, CASE WHEN NOT bad THEN zs END AS z_scores, CASE WHEN bad THEN 'op_not_predict' END AS error FROM sv""")
def predictions_full(spark, sf_dir):
    out = served(spark, sf_dir)
    return out.select("match_id", "player_id", "status", F.round(F.col("risk_score").cast("double"), 5).alias("risk_score"), "risk_level", F.col("decision.policy_rule").alias("policy_rule"), _shown(F.col("evidence")).alias("features"), _shown(F.col("evidence"), "z").alias("z_scores"), "error")


@query(f"{_PREDS} SELECT CAST(least(floor(risk_score::DOUBLE * 10), 9) AS INTEGER) AS bin, risk_level, count(*) AS predictions FROM lv GROUP BY 1, 2")
def risk_histogram(spark, sf_dir):
    return reports.risk_histogram(_preds(spark, sf_dir))


@query(f"{_PREDS} SELECT risk_level, count(*) AS predictions, count(*)::DOUBLE / sum(count(*)) OVER () AS share FROM lv GROUP BY 1")
def risk_level_share(spark, sf_dir):
    return reports.risk_level_share(_preds(spark, sf_dir))


@query(f"{_PREDS} SELECT match_id, player_id, round(risk_score::DOUBLE, 5) AS risk_score FROM lv ORDER BY lv.risk_score DESC, match_id, player_id LIMIT 50")
def rank_predictions(spark, sf_dir):
    """The report's top 50."""
    return reports.rank_predictions(_preds(spark, sf_dir), n=50).select("match_id", "player_id", F.round(F.col("risk_score").cast("double"), 5).alias("risk_score"))


@query(f"{_PREDS} SELECT 'risk_level' AS field, risk_level AS value FROM lv GROUP BY 1, 2 UNION ALL SELECT 'match_id', match_id FROM lv GROUP BY 1, 2")
def distinct_filter_values(spark, sf_dir):
    return reports.distinct_filter_values(_preds(spark, sf_dir), ["risk_level", "match_id"])


_MAN = f"""WITH m AS ({A.MESSAGES}), o AS (SELECT batch, part, min(off) AS lo, max(off) AS hi FROM m GROUP BY 1, 2),
i AS (SELECT batch, sha256(string_agg('p' || part || ':' || lo || '-' || hi || '|', '' ORDER BY part)) AS batch_id FROM o GROUP BY 1),
c AS (SELECT batch, count(*) AS total_records_read, count(*) FILTER (WHERE status = 'valid') AS valid_records, count(*) FILTER (WHERE status = 'invalid') AS invalid_records, count(*) FILTER (WHERE status = 'valid' AND dup) AS duplicate_records FROM m GROUP BY 1),
man AS (SELECT * FROM i JOIN c USING (batch))"""


def _manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.batch_manifest(A.messages(spark, sf_dir), by=["batch"])


@query(f"{_MAN} SELECT batch, batch_id, total_records_read, valid_records AS valid_records_count, invalid_records AS invalid_records_count, duplicate_records AS duplicate_records_count FROM man")
def batch_manifest(spark, sf_dir):
    return _manifests(spark, sf_dir).select("batch", "batch_id", "total_records_read", "valid_records_count", "invalid_records_count", "duplicate_records_count")


@query(f"{_MAN} SELECT batch_id, part AS kafka_partition, lo AS first_offset, hi AS last_offset, total_records_read AS record_count, valid_records AS valid_record_count FROM man JOIN o USING (batch)")
def contract_manifest(spark, sf_dir):
    return B.contract_manifest(_manifests(spark, sf_dir)).select("batch_id", "kafka_partition", "first_offset", "last_offset", "record_count", "valid_record_count")


@query(f"{_MAN} SELECT batch, part AS \"partition\", lo AS min_offset, hi AS max_offset FROM o")
def partition_offsets(spark, sf_dir):
    return B.partition_offsets(A.messages(spark, sf_dir), ["batch"])


@query(f"{_MAN} SELECT batch, batch_id FROM i")
def batch_id(spark, sf_dir):
    return B.batch_id(B.partition_offsets(A.messages(spark, sf_dir), ["batch"]), ["batch"])


@query(f"""{_MAN}, t AS (SELECT CAST(sum(total_records_read) AS BIGINT) AS total_raw, CAST(sum(valid_records) AS BIGINT) AS total_valid, CAST(sum(invalid_records + duplicate_records) AS BIGINT) AS total_invalid, count(*) AS total_batches FROM man),
k AS ({A.KILLS}), {_PEOPLE} SELECT t.*, greatest(total_batches, total_valid // 70) AS estimated_matches, total_valid AS estimated_players, total_valid AS estimated_predictions, CAST(floor(total_valid * 0.05) AS BIGINT) AS estimated_high_risk,
(SELECT count(DISTINCT match_id) FROM p) AS matches, (SELECT count(DISTINCT player_id) FROM p) AS players FROM t""")
def pipeline_summary(spark, sf_dir):
    return reports.pipeline_summary(_manifests(spark, sf_dir), silver.participants(A.kills(spark, sf_dir)))


@query(f"{_MAN} SELECT round(sum(valid_records)::DOUBLE / sum(total_records_read) * 100, 8) AS retention_rate FROM man")
def retention_rate(spark, sf_dir):
    return reports.retention_rate(_manifests(spark, sf_dir)).select(F.round("retention_rate", 8).alias("retention_rate"))


@query(f"{_MAN} SELECT batch_id, 'before' AS stage, total_records_read AS records FROM man UNION ALL SELECT batch_id, 'after', valid_records FROM man")
def batch_before_after(spark, sf_dir):
    return reports.batch_before_after(_manifests(spark, sf_dir))


@query(f"{_MAN} SELECT left(batch_id, 8) AS batch, valid_records, invalid_records + duplicate_records AS rejected_records FROM man")
def batch_throughput(spark, sf_dir):
    return reports.batch_throughput(_manifests(spark, sf_dir))


@query(f"{_BRONZE_SQL} SELECT 'bronze' AS layer, count(*) AS rows FROM b UNION ALL SELECT 'kill_events', count(*) FROM k UNION ALL SELECT 'player_match', count(*) FROM (SELECT DISTINCT match_id, player_id FROM s)")
def layer_row_counts(spark, sf_dir):
    return reports.layer_row_counts({"bronze": A.bronze(spark, sf_dir), "kill_events": A.kills(spark, sf_dir), "player_match": _pm(spark, sf_dir)})


@query(f"{WITH_KILLS} SELECT count(*) AS total_events, round(avg({_DIST}), 6) AS mean_distance, count(*) FILTER (WHERE {_DIST} > 800) AS anomalies FROM k")
def kill_event_summary(spark, sf_dir):
    return reports.kill_event_summary(A.kills(spark, sf_dir), 800.0).withColumn("mean_distance", F.round("mean_distance", 6))


@query(f"""{WITH_KILLS}, x AS (SELECT 'killer' AS side, killer_position_x AS x, killer_position_y AS y FROM k UNION ALL SELECT 'victim', victim_position_x, victim_position_y FROM k)
SELECT side, CAST(floor(x / 100) AS BIGINT) AS cell_x, CAST(floor(y / 100) AS BIGINT) AS cell_y, count(*) AS events FROM x WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY 1, 2, 3""")
def kill_position_grid(spark, sf_dir):
    return reports.kill_position_grid(A.kills(spark, sf_dir), 100.0)


@query("WITH i AS (SELECT DISTINCT event_id AS i FROM events WHERE event_type <> 'error' AND event_id > 0 UNION SELECT 0) SELECT min(i) AS high_water_mark FROM i WHERE i + 1 NOT IN (SELECT i FROM i)")
def contiguous_high_water_mark(spark, sf_dir):
    acked = A.table(spark, sf_dir, "events").where("event_type <> 'error'").select(F.col("event_id").alias("record_index"))
    return reports.contiguous_high_water_mark(acked, 0)


@query(f"{WITH_STATS} SELECT match_id, player_id, count(*) AS n FROM s GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(A.stats(spark, sf_dir))


@query("WITH f AS (SELECT DISTINCT 'day=' || CAST(CAST(ts AS DATE) AS VARCHAR) AS path FROM events), d AS (SELECT DISTINCT 'day=' || CAST(CAST(ts AS DATE) AS VARCHAR) AS path FROM events WHERE event_id % 500 = 0) SELECT path FROM f WHERE path NOT IN (SELECT path FROM d)")
def unprocessed_files(spark, sf_dir):
    e = A.table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("day="), F.col("ts").cast("date").cast("string")).alias("path"))
    return reports.unprocessed_files(e.select("path").distinct(), e.where("event_id % 500 = 0").select("path").distinct())


_INVARIANTS = """
  SELECT 'I1_bronze_not_empty' AS invariant, CASE WHEN (SELECT count(*) FROM bz) = 0 THEN 1 ELSE 0 END AS violations
  UNION ALL SELECT 'I2_kill_events_not_empty', CASE WHEN (SELECT count(*) FROM ke) = 0 THEN 1 ELSE 0 END
  UNION ALL SELECT 'I3_player_match_not_empty', CASE WHEN (SELECT count(*) FROM pms) = 0 THEN 1 ELSE 0 END
  UNION ALL SELECT 'I4_gold_not_empty', CASE WHEN (SELECT count(*) FROM gs) = 0 THEN 1 ELSE 0 END
  UNION ALL SELECT 'I5_kill_rows_equal_bronze', abs((SELECT count(*) FROM bz WHERE op = 'data.kill_event.raw') - (SELECT count(*) FROM ke))
  UNION ALL SELECT 'I6_no_duplicate_player_match', (SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM pms GROUP BY match_id, player_id) WHERE n > 1)
  UNION ALL SELECT 'I7_no_synthetic_kill_rows', (SELECT count(*) FROM ke WHERE killer_name LIKE '%player_suspect\\_%' ESCAPE '\\' OR killer_name LIKE '%player_alpha\\_%' ESCAPE '\\' OR victim_name LIKE '%player_suspect\\_%' ESCAPE '\\' OR victim_name LIKE '%player_alpha\\_%' ESCAPE '\\')
  UNION ALL SELECT 'I7_no_synthetic_player_rows', (SELECT count(*) FROM pms WHERE player_id LIKE '%player_suspect\\_%' ESCAPE '\\' OR player_id LIKE '%player_alpha\\_%' ESCAPE '\\')"""


@query(f"""{_BRONZE_SQL}, bz AS (SELECT op FROM b), ke AS (SELECT killer_name, victim_name FROM k), pms AS (SELECT match_id, player_id FROM s UNION SELECT match_id, unnest([sha256(killer_name), sha256(victim_name)]) FROM k), gs AS (SELECT * FROM pms),
v AS ({_INVARIANTS}) SELECT invariant, CAST(violations AS BIGINT) AS violations FROM v""")
def invariants(spark, sf_dir):
    b = silver.canonical_identity(A.bronze(spark, sf_dir))
    k, pm = silver.to_silver_kill_events(b), silver.player_match(b)
    return quality.verify_invariants(b, k, pm, gold.gold_features(pm, k, SHORT))


_MARKED = "CASE WHEN event_id % 23 = 0 THEN 'player_suspect_' || user_id WHEN event_id % 29 = 0 THEN 'x_player_alpha_' || user_id ELSE 'u' || user_id END"


@query(f"""{_BRONZE_SQL}, ke AS (SELECT {_MARKED} AS killer_name, 'v' AS victim_name FROM events WHERE event_id % 7 <> 0), pms AS (SELECT match_id, {_MARKED.replace("user_id", "(l_suppkey)").replace("event_id", "(l_orderkey)").replace("'u'", "'s'")} AS player_id FROM s),
bz AS (SELECT op FROM b), gs AS (SELECT 1 WHERE false), v AS ({_INVARIANTS}) SELECT invariant, CAST(violations AS BIGINT) AS violations FROM v""")
def invariants_broken(spark, sf_dir):
    """The same rules over layers that break them: lost kill rows, repeated players, marked names, no gold."""
    def marked(at: str, who: str, prefix: str) -> Column:
        name = F.col(who).cast("string")
        return F.when(F.col(at) % 23 == 0, F.concat(F.lit("player_suspect_"), name)).when(F.col(at) % 29 == 0, F.concat(F.lit("x_player_alpha_"), name)).otherwise(F.concat(F.lit(prefix), name))

    b = silver.canonical_identity(A.bronze(spark, sf_dir))
    k = A.table(spark, sf_dir, "events").where("event_id % 7 <> 0").select(marked("event_id", "user_id", "u").alias("killer_name"), F.lit("v").alias("victim_name"))
    pm = A.stats(spark, sf_dir).select("match_id", marked("l_orderkey", "l_suppkey", "s").alias("player_id"))
    return quality.verify_invariants(b, k, pm, pm.where("false"))


@query(f"""{_GOLD}, gs AS (SELECT DISTINCT match_id FROM gold), t AS (SELECT match_id FROM gs ORDER BY sha256('42:' || match_id), match_id LIMIT (SELECT CAST(ceil(count(*) * 0.2) AS BIGINT) FROM gs))
SELECT match_id, CASE WHEN match_id IN (SELECT match_id FROM t) THEN 'test' ELSE 'train' END AS side, count(*) AS n FROM gold GROUP BY 1, 2""")
def group_split(spark, sf_dir):
    train, test = ml.group_split(_gold(spark, sf_dir))
    both = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    return both.groupBy("match_id", "side").agg(F.count("*").alias("n"))


_SCORED = "x AS (SELECT toxic AS y, ((doc_id * 7919) % 1000) / 1000.0::DOUBLE * 0.5 + toxic * 0.3 AS s FROM labels)"


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = ((F.col("doc_id") * 7919) % 1000) / 1000.0 * 0.5 + F.col("toxic") * 0.3
    return A.table(spark, sf_dir, "labels").select(F.col("toxic").alias("label"), s.alias("score"), "doc_id")


@query(f"""WITH {_SCORED}, c AS (SELECT count(*) FILTER (WHERE s >= 0.5 AND y = 1) AS tp, count(*) FILTER (WHERE s >= 0.5 AND y = 0) AS fp, count(*) FILTER (WHERE s < 0.5 AND y = 1) AS fn, count(*) AS n FROM x)
SELECT round(tp / (tp + fp)::DOUBLE, 8) AS precision, round(tp / (tp + fn)::DOUBLE, 8) AS recall, round(2 * tp / (2 * tp + fp + fn)::DOUBLE, 8) AS f1, n AS rows FROM c""")
def classification_metrics(spark, sf_dir):
    return ml.classification_metrics(_scored(spark, sf_dir)).select(*(F.round(c, 8).alias(c) for c in ("precision", "recall", "f1")), "rows")


@query(f"""WITH {_SCORED}, g AS (SELECT s, count(*) AS n, sum(y) AS p FROM x GROUP BY 1), r AS (SELECT p, sum(p) OVER (ORDER BY s DESC) AS cp, sum(n) OVER (ORDER BY s DESC) AS cn FROM g)
SELECT round(sum(p * cp / cn::DOUBLE) / sum(p), 8) AS average_precision FROM r""")
def average_precision(spark, sf_dir):
    return ml.classification_metrics(_scored(spark, sf_dir)).select(F.round("average_precision", 8).alias("average_precision"))


@query(f"""WITH x AS (SELECT doc_id, toxic AS y, ((doc_id * 7919) % 1000) / 1000.0::DOUBLE * 0.5 + toxic * 0.3 AS s FROM labels), r AS (SELECT *, row_number() OVER (ORDER BY s, doc_id) AS k, count(*) OVER () AS n FROM x)
SELECT doc_id, CAST(k <= greatest(1, round_even(n * 0.05::DOUBLE, 0)) AS INTEGER) AS pseudo_label FROM r""")
def pseudo_labels(spark, sf_dir):
    return ml.pseudo_labels(_scored(spark, sf_dir), ["doc_id"], "score").select("doc_id", "pseudo_label")


@query("WITH x AS (SELECT ((doc_id * 7919) % 1000) / 1000.0::DOUBLE * 0.5 + toxic * 0.3 AS s FROM labels) SELECT round(quantile_cont(s, 0.05), 8) AS p05, round(avg(s), 8) AS mean FROM x")
def anomaly_score_summary(spark, sf_dir):
    return ml.anomaly_score_summary(_scored(spark, sf_dir), "score").select(F.round("p05", 8).alias("p05"), F.round("mean", 8).alias("mean"))


_COMPLETE = "minimum_kill_interval_seconds IS NOT NULL AND median_kill_distance_coordinate_units IS NOT NULL"


_FOREST_X = ["CAST(kills AS DOUBLE)", "minimum_kill_interval_seconds", "median_kill_distance_coordinate_units", "CAST(short_kill_interval_count AS DOUBLE)", "CAST(unique_weapons_used AS DOUBLE)"]
_HEX = "CAST('0x' || substr(md5({0}), {1}, 7) AS BIGINT)"


def _forest_sql(trees: int = 100, sample: int = 256, levels: int = 8) -> str:
    """The forest by its rules: draws of rows, splits level by level, then the walk of every row through every tree."""
    xs = ", ".join(f"{x} AS x{i}" for i, x in enumerate(_FOREST_X))
    x = "[" + ", ".join(f"x{i}" for i in range(5)) + "]"
    spans = ", ".join(f"{{'f': {i}, 'low': min(x{i}) OVER w, 'high': max(x{i}) OVER w}}" for i in range(5))
    split = "'42:' || tree || ':' || node"
    sql = f"""{_GOLD}, c AS (SELECT match_id, player_id, {xs}, match_id || '|' || player_id AS name FROM gold WHERE {_COMPLETE}),
h AS (SELECT *, {_HEX.format("name", 1)} AS h0, {_HEX.format("name", 8)} AS h1 FROM c),
d AS (SELECT h.*, t.tree, (h0 + t.tree * h1) % 268435399 AS draw FROM h, range({trees}) t(tree)),
l0 AS (SELECT tree, {", ".join(f"x{i}" for i in range(5))}, 0 AS node, false AS leaf, 0 AS depth FROM d QUALIFY row_number() OVER (PARTITION BY tree ORDER BY draw, name) <= {sample})"""
    for k in range(levels):
        sql += f""",
w{k} AS (SELECT *, list_filter([{spans}], lambda e: e.high > e.low) AS wide FROM l{k} WINDOW w AS (PARTITION BY tree, node)),
s{k} AS (SELECT *, wide[1 + {_HEX.format(split, 1)} % greatest(len(wide), 1)] AS pick, {_HEX.format(split, 8)} / 268435456.0::DOUBLE AS u FROM w{k}),
l{k + 1} AS (SELECT tree, x0, x1, x2, x3, x4, leaf OR len(wide) = 0 AS leaf, CASE WHEN leaf OR len(wide) = 0 THEN depth ELSE depth + 1 END AS depth,
  CASE WHEN leaf OR len(wide) = 0 THEN node WHEN {x}[pick.f + 1] < pick.low + u * (pick.high - pick.low) THEN 2 * node + 1 ELSE 2 * node + 2 END AS node FROM s{k})"""
    nodes = " UNION ALL ".join(f"SELECT DISTINCT tree, node, pick.f AS f, pick.low + u * (pick.high - pick.low) AS cut FROM s{k} WHERE NOT leaf AND len(wide) > 0" for k in range(levels))
    sql += f""",
nodes AS ({nodes}),
ends AS (SELECT tree, node, max(depth) + CASE WHEN count(*) > 2 THEN 2 * (ln(count(*) - 1.0::DOUBLE) + 0.5772156649015329::DOUBLE) - 2 * (count(*) - 1.0::DOUBLE) / count(*) WHEN count(*) = 2 THEN 1.0 ELSE 0.0 END AS length FROM l{levels} GROUP BY 1, 2),
p0 AS (SELECT name, {x} AS x, tree, 0 AS node FROM c, range({trees}) t(tree))"""
    for k in range(levels):
        sql += f", p{k + 1} AS (SELECT name, x, p.tree, CASE WHEN n.f IS NULL THEN p.node WHEN x[n.f + 1] < n.cut THEN 2 * p.node + 1 ELSE 2 * p.node + 2 END AS node FROM p{k} p LEFT JOIN nodes n ON p.tree = n.tree AND p.node = n.node)"
    # the expected path among the sample, or among all rows where they are fewer
    return sql + f""",
e AS (SELECT CASE WHEN m > 2 THEN 2 * (ln(m - 1.0::DOUBLE) + 0.5772156649015329::DOUBLE) - 2 * (m - 1.0::DOUBLE) / m ELSE 1.0 END AS expected FROM (SELECT least({sample}, count(*)) AS m FROM c)),
a AS (SELECT name, -pow(2.0::DOUBLE, -(sum(length) / {trees}) / any_value(expected)) AS score FROM p{levels} p JOIN ends USING (tree, node), e GROUP BY name)
SELECT match_id, player_id, round(score - (SELECT quantile_cont(score, 0.05) FROM a), 6) + 0.0 AS anomaly_score FROM c JOIN a USING (name)"""


@query(_forest_sql())
def isolation_forest_scores(spark, sf_dir):
    """M4: scores of all complete gold rows by a forest grown from them."""
    g = _written(spark, _gold(spark, sf_dir), "forest-gold")
    scored = ml.isolation_forest_score(g, ml.isolation_forest_fit(g, ids=["match_id", "player_id"]))
    return scored.select("match_id", "player_id", (F.round("anomaly_score", 6) + 0.0).alias("anomaly_score"))


_LABEL = "short_kill_interval_count >= 2 OR kills % 3 = 0"
_BINNED = f"""{_GOLD}, c AS (SELECT match_id, player_id, CAST({_LABEL} AS INTEGER) AS y, {", ".join(f"CAST({c} AS DOUBLE) AS x{i}" for i, c in enumerate(S.FEATURES))} FROM gold WHERE {_COMPLETE}),
ranks AS (SELECT *, {", ".join(f"dense_rank() OVER (ORDER BY x{i}) AS d{i}, count(*) OVER (ORDER BY x{i}) AS r{i}" for i in range(5))} FROM c),
held AS (SELECT *, {", ".join(f"CASE WHEN max(d{i}) OVER () <= 256 THEN d{i} - 1 ELSE (r{i} - 1) * 256 // count(*) OVER () END AS q{i}" for i in range(5))} FROM ranks),
binned AS (SELECT match_id, player_id, y, {", ".join(f"x{i}, dense_rank() OVER (ORDER BY q{i}) - 1 AS b{i}" for i in range(5))} FROM held)"""


def _boosted_sql(rounds: int, depth: int) -> str:
    """Plain boosting of the same bins, over rows: each level's sums by node, column and bin, their prefixes, and the best."""
    sql = f"""{_BINNED},
m0 AS (SELECT match_id, player_id, y, [b0, b1, b2, b3, b4] AS b, ln(avg(y) OVER () / (1 - avg(y) OVER ())) AS m FROM binned)"""
    for r in range(rounds):
        sql += f""",
n{r}_0 AS MATERIALIZED (SELECT *, 1 / (1 + exp(-m)) AS p, 0 AS node, true AS grows FROM m{r})"""
        for k in range(depth):
            sql += f""",
h{r}_{k} AS (SELECT node, f, b[f + 1] AS bin, sum(p - y) AS g, sum(p * (1 - p)) AS h FROM n{r}_{k}, range(5) t(f) WHERE grows GROUP BY ALL),
s{r}_{k} AS (SELECT node, f, bin, sum(g) OVER run AS gl, sum(h) OVER run AS hl, sum(g) OVER col AS gt, sum(h) OVER col AS ht FROM h{r}_{k} WINDOW col AS (PARTITION BY node, f), run AS (PARTITION BY node, f ORDER BY bin)),
w{r}_{k} AS (SELECT *, gl * gl / (hl + 1) + (gt - gl) * (gt - gl) / (ht - hl + 1) - gt * gt / (ht + 1) AS gain FROM s{r}_{k}),
best{r}_{k} AS (SELECT node, f, bin FROM w{r}_{k} WHERE hl >= 1 AND ht - hl >= 1 AND gain > 1e-6 QUALIFY row_number() OVER (PARTITION BY node ORDER BY round(gain, 9) DESC, f, bin) = 1),
n{r}_{k + 1} AS MATERIALIZED (SELECT match_id, player_id, y, b, m, p, CASE WHEN s.node IS NULL THEN n.node WHEN b[f + 1] <= bin THEN 2 * n.node + 1 ELSE 2 * n.node + 2 END AS node, s.node IS NOT NULL AS grows
  FROM n{r}_{k} n LEFT JOIN best{r}_{k} s ON n.node = s.node AND n.grows)"""
        sql += f""",
m{r + 1} AS MATERIALIZED (SELECT match_id, player_id, y, b, m - 0.3 * (sum(p - y) OVER leaf) / (1 + sum(p * (1 - p)) OVER leaf) AS m FROM n{r}_{depth} WINDOW leaf AS (PARTITION BY node))"""
    return sql + f" SELECT match_id, player_id, round(1 / (1 + exp(-m)), 5) AS risk_score FROM m{rounds}"


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.finite_features(_gold(spark, sf_dir)).withColumn("y", F.expr(f"CAST({_LABEL} AS INT)"))


@query(f"{_BINNED} SELECT f, bin, count(*) AS rows, min(x) AS least FROM (SELECT unnest([{', '.join(f'{{f: {i}, bin: b{i}, x: x{i}}}' for i in range(5))}], recursive := true) FROM binned) GROUP BY f, bin")
def feature_bins(spark, sf_dir):
    """M3: the bins of the five gold features, with their rows and least values."""
    rows = _labelled(spark, sf_dir)
    edges = boosting.bin_edges(rows, S.FEATURES)
    each = F.explode(F.array(*(F.struct(F.lit(i).alias("f"), boosting.bin_of(F.col(c).cast("double"), e).cast("long").alias("bin"), F.col(c).cast("double").alias("x")) for i, (c, e) in enumerate(zip(S.FEATURES, edges, strict=True)))))
    return rows.select(each.alias("e")).groupBy("e.f", "e.bin").agg(F.count("*").alias("rows"), F.min("e.x").alias("least"))


@query(_boosted_sql(3, 3))
def boosted_scores(spark, sf_dir):
    """M3, D-1: scores of all complete gold rows by three trees of three levels, each row's walk a column expression."""
    rows = _labelled(spark, sf_dir)
    model = boosting.fit(rows, S.FEATURES, "y", rounds=3, depth=3)
    return rows.select("match_id", "player_id", F.round(model.score(f"array({', '.join(S.FEATURES)})"), 5).alias("risk_score"))


def _trained(spark: SparkSession, metrics: dict, f1: str, least: float) -> DataFrame:
    return spark.createDataFrame([(metrics["mode"], metrics["rows"], metrics[f1] >= least)], "mode string, rows long, learned boolean")


@query(f"{_GOLD} SELECT 'unsupervised' AS mode, count(*) AS rows, true AS learned FROM gold WHERE {_COMPLETE}")
def train_unsupervised(spark, sf_dir):
    """Isolation forest, pseudo-labels and surrogate over all complete gold rows: 100 trees and 100 boosting rounds of depth 10."""
    return _trained(spark, ml.train_unsupervised(_written(spark, _gold(spark, sf_dir), "train-gold"))[1], "surrogate_f1", 0.8)


@query(f"""{_GOLD}, c AS (SELECT * FROM gold WHERE {_COMPLETE}), gs AS (SELECT DISTINCT match_id FROM c), t AS (SELECT match_id FROM gs ORDER BY sha256('42:' || match_id), match_id LIMIT (SELECT CAST(ceil(count(*) * 0.2) AS BIGINT) FROM gs))
SELECT 'supervised' AS mode, count(*) AS rows, true AS learned FROM c WHERE match_id IN (SELECT match_id FROM t)""")
def train_supervised(spark, sf_dir):
    """A label that one feature tells must be learned, in 100 boosting rounds of depth 10."""
    g = _written(spark, _gold(spark, sf_dir), "train-gold").withColumn("is_suspicious", (F.col("short_kill_interval_count") >= 2).cast("int"))
    return _trained(spark, ml.train_supervised(g)[1], "f1", 0.99)


def gaps(streamed: DataFrame, batch: DataFrame, cols: list[str]) -> DataFrame:
    """Rows of either side that the other lacks, repeats counted, and those of the stream, each side read once."""
    each = streamed.withColumn("n", F.lit(1)).unionByName(batch.withColumn("n", F.lit(-1))).groupBy(*cols).agg(F.sum("n").alias("gap"), F.count_if(F.col("n") > 0).alias("streamed"))
    sums = each.agg(F.sum(F.greatest("gap", F.lit(0))).alias("stream_only"), F.sum(F.greatest(-F.col("gap"), F.lit(0))).alias("batch_only"), F.sum("streamed").alias("streamed"))
    sides = F.array(*(F.struct(F.lit(c).alias("side"), F.col(c).cast("bigint").alias("rows")) for c in ("stream_only", "batch_only", "streamed")))
    return sums.select(F.inline(sides)).where("rows > 0")


@query(f"{_GOLD} SELECT 'streamed' AS side, count(*) AS rows FROM gold")
def stream_equals_batch(spark, sf_dir):
    """All kills as topic messages through the streaming pipeline, in files of several micro-batches, against the batch plan: rows of either that the other lacks."""
    root = scratch(spark, "stream")
    k = A.kills(spark, sf_dir)
    raw = k.select("match_id", "killer_name", "victim_name", F.col("event_time_seconds").cast("string").alias("time"), "killer_position_x", "killer_position_y", "victim_position_x", "victim_position_y", F.col("weapon").alias("killed_by"), F.lit("events.csv").alias("source_file"), F.col("row_id").alias("record_index"))
    env = normalize.normalize(raw, "events", F.lit("2026-01-01T00:00:00Z"))
    good, _ = normalize.split_valid_invalid(env)
    at = F.col("source.record_index")
    sent = good.select(F.col("match_id").cast("binary").alias("key"), F.to_json(F.struct("*")).cast("binary").alias("value"), F.lit("raw").alias("topic"), (at % 6).cast("int").alias("partition"), F.floor(at / 6).cast("bigint").alias("offset"), F.current_timestamp().alias("timestamp"))
    with shuffles_removed(spark):
        sent.repartition(4).write.option("parquet.block.size", 8 << 20).option("compression", "zstd").parquet(f"{root}/messages")  # a batch's few files are read by many tasks
    stream = readers.read_message_files(spark, f"{root}/messages", max_files=2)
    pipeline.start_pipeline(stream, f"{root}/lake", f"{root}/checkpoint", short_interval_threshold=SHORT).awaitTermination()
    cols = ["match_id", "player_id", *S.FEATURES]
    streamed = lake.current(spark, f"{root}/lake", "gold").select(*cols)
    names = good.select("match_id", F.col("payload.killer_name").alias("killer_name"), F.col("payload.victim_name").alias("victim_name"), *(F.col(f"payload.{c}").alias(c) for c in ("event_time_seconds", "killer_position_x", "killer_position_y", "victim_position_x", "victim_position_y", "weapon")))
    pm = silver.participants(names).withColumn("kills", F.lit(0).cast("bigint"))
    batch = gold.gold_features(pm, names, SHORT).select(*cols)
    return gaps(streamed, batch, cols)


@query(f"{WITH_KILLS} SELECT row_id, {_DIST} AS distance FROM k")
def kill_distance(spark, sf_dir):
    return A.kills(spark, sf_dir).select("row_id", distance("killer_position_x", "killer_position_y", "victim_position_x", "victim_position_y").alias("distance"))


from . import lake_queries  # noqa: E402, F401  the queries of sources, sinks and checks register themselves
