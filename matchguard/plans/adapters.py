"""The given tables read as telemetry: events as kills, lineitem as player statistics, labels as scored truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators.bronze import to_bronze, union_envelopes

KILLS = """
SELECT event_id AS row_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS match_id, 'u' || CAST(user_id AS VARCHAR) AS killer_name,
       'u' || CAST((event_id * 7 + 3) % 150 AS VARCHAR) AS victim_name, CAST(event_id % 50 AS INTEGER) AS killer_placement, CAST(event_id % 40 AS INTEGER) AS victim_placement,
       CAST(epoch_us(ts) % 86400000000 AS DOUBLE) / 1e6 AS event_time_seconds, value AS killer_position_x,
       CAST(json_extract_string(props, '$.k') AS DOUBLE) AS killer_position_y, CAST(event_id % 1000 AS DOUBLE) AS victim_position_x,
       CAST(event_id % 777 AS DOUBLE) AS victim_position_y, CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS weapon
FROM events"""

STATS = """
SELECT sha256('lineitem:' || CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR)) AS event_id, 'm' || CAST(l_orderkey % 100 AS VARCHAR) AS match_id,
       's' || CAST(l_suppkey AS VARCHAR) AS player_id, CAST(l_quantity AS BIGINT) AS kills, CAST((l_linenumber * l_suppkey) % 12 AS BIGINT) AS headshot_kills,
       l_extendedprice AS damage_dealt, l_partkey * 10.0::DOUBLE AS walk_distance, l_discount * 10000 AS ride_distance, l_tax * 1000 AS swim_distance,
       CAST((l_orderkey * 7 + l_linenumber) % 1800 AS DOUBLE) AS survival_duration, l_discount * 12 AS win_place_perc,
       l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_suppkey
FROM lineitem"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kills(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = (F.hour("ts") * 3600 + F.minute("ts") * 60) + F.expr("extract(SECOND FROM ts)")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("row_id"), F.col("ts").cast("date").cast("string").alias("match_id"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("killer_name"),
        F.concat(F.lit("u"), ((F.col("event_id") * 7 + 3) % 150).cast("string")).alias("victim_name"), (F.col("event_id") % 50).cast("int").alias("killer_placement"), (F.col("event_id") % 40).cast("int").alias("victim_placement"),
        seconds.cast("double").alias("event_time_seconds"), F.col("value").alias("killer_position_x"), F.get_json_object("props", "$.k").cast("double").alias("killer_position_y"),
        (F.col("event_id") % 1000).cast("double").alias("victim_position_x"), (F.col("event_id") % 777).cast("double").alias("victim_position_y"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("weapon"),
    )


def stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows; the table's keys stay for ordering."""
    return table(spark, sf_dir, "lineitem").select(
        F.sha2(F.concat_ws(":", F.lit("lineitem"), "l_orderkey", "l_linenumber"), 256).alias("event_id"), F.concat(F.lit("m"), (F.col("l_orderkey") % 100).cast("string")).alias("match_id"),
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("player_id"), F.col("l_quantity").cast("bigint").alias("kills"), ((F.col("l_linenumber") * F.col("l_suppkey")) % 12).cast("bigint").alias("headshot_kills"),
        F.col("l_extendedprice").alias("damage_dealt"), (F.col("l_partkey") * 10.0).alias("walk_distance"), (F.col("l_discount") * 10000).alias("ride_distance"), (F.col("l_tax") * 1000).alias("swim_distance"),
        ((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 1800).cast("double").alias("survival_duration"), (F.col("l_discount") * 12).alias("win_place_perc"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_suppkey",
    )


def _enveloped(df: DataFrame, op: str, event: Column, player: Column, payload: list[Column], record: Column) -> DataFrame:
    source = F.struct(F.lit("tables").alias("provider"), F.lit(op).alias("dataset_id"), F.lit("given.parquet").alias("source_file"), record.cast("bigint").alias("record_index"))
    return df.select(event.alias("event_id"), F.lit("1.0").alias("schema_version"), F.lit(op).alias("op"), F.lit(None).cast("string").alias("event_time"), F.lit("2026-01-01T00:00:00Z").alias("ingest_time"), "match_id", player.alias("player_id"), source.alias("source"), F.struct(*payload).alias("payload"))


def kill_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kills as envelopes that name people raw and their player by hash, as the reference does."""
    k = kills(spark, sf_dir)
    return _enveloped(k, S.OP_KILL_RAW, F.sha2(F.concat(F.lit("kill:"), F.col("row_id").cast("string")), 256), F.sha2("killer_name", 256), [F.col(c) for c in k.columns if c != "row_id"], F.col("row_id"))


def stat_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stats(spark, sf_dir)
    return _enveloped(s, S.OP_MATCH_SUMMARY, F.col("event_id"), F.col("player_id"), [F.col(c) for c in S.METRICS], F.col("l_orderkey"))


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_envelopes(stat_envelopes(spark, sf_dir), kill_envelopes(spark, sf_dir))


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_bronze(envelopes(spark, sf_dir))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as audited topic messages: batch, partition, offset, status, duplicate."""
    e = table(spark, sf_dir, "events")
    offset = F.floor(F.col("event_id") / 6).cast("bigint")
    status = F.when(F.col("event_type") == "error", "invalid").when(F.col("user_id") % 50 == 0, "malformed").otherwise("valid")
    return e.select(F.floor(offset / 100).cast("bigint").alias("batch"), (F.col("event_id") % 6).cast("int").alias("partition"), offset.alias("offset"), status.alias("status"), (F.col("event_id") % 97 == 0).alias("duplicate"))


MESSAGES = """
SELECT CAST(floor((event_id // 6) / 100) AS BIGINT) AS batch, CAST(event_id % 6 AS INTEGER) AS part, event_id // 6 AS off,
       CASE WHEN event_type = 'error' THEN 'invalid' WHEN user_id % 50 = 0 THEN 'malformed' ELSE 'valid' END AS status, event_id % 97 = 0 AS dup
FROM events"""
