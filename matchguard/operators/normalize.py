"""CSV rows to envelopes (P1-P8), replay slices (S2, S3) and replay counts.

Unparseable cells, like blank ones, count as 0 in later rules, so one bad cell
can give two errors: that is the reference's behaviour.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.expr import any_of, finite, number, reasons, rfc3339_now, sha256, trimmed, whole
from ..sources.folders import scratch
from .ranks import ranked

SYSTEM = {"source_file", "source_path", "source_offset", "source_line", "record_index"}
_STAT_CELLS = {"damage_dealt": "damageDealt", "walk_distance": "walkDistance", "ride_distance": "rideDistance", "swim_distance": "swimDistance", "survival_duration": "matchDuration"}
_KILL_CELLS = ["killer_position_x", "killer_position_y", "victim_position_x", "victim_position_y"]


def detect_schema(df: DataFrame) -> str:
    """The layout that a header names; unknown ones are read as finish_placement."""
    names = set(df.columns)
    if names & {"killer_name", "victim_name"}:
        return "match_deaths"
    return "finish_placement" if names & {"winPlacePerc", "Id"} else "unknown"


def with_record_index(df: DataFrame, file_col: str | None = None) -> DataFrame:
    """1-based row number in each file, in two passes and without a global window.

    Rows are numbered inside each block that the scan cut a file into (without
    ``source_offset``: inside each task's part of it) by ``source_line`` or, without
    that, as they come, after the rows of its earlier blocks. ``file_col`` defaults to ``source_path``, else ``source_file``;
    where it names a file kept in parts, these follow each other by ``source_path``.
    Blocks without a gap between their lines, all but those with blank lines or line ends in quotes, are numbered where they are read; only others are shuffled.
    """
    file_col = file_col or ("source_path" if "source_path" in df.columns else "source_file")
    part = F.col("source_path") if "source_path" in df.columns else F.lit("")
    block = F.col("source_offset") if "source_offset" in df.columns else F.spark_partition_id()
    at = df.withColumn("_id", F.col("source_line") if "source_line" in df.columns else F.monotonically_increasing_id()).withColumn("_part", part).withColumn("_block", block)
    keys = [file_col, "_part", "_block"]
    counts = at.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("_id").alias("_first"), F.max("_id").alias("_last"))
    earlier = Window.partitionBy(file_col).orderBy("_part", "_block").rowsBetween(Window.unboundedPreceding, -1)
    numbered = counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).withColumn("_dense", F.col("_last") - F.col("_first") + 1 == F.col("_n"))
    path = scratch(df.sparkSession, "blocks")
    numbered.select(*keys, "_before", "_first", "_dense").write.parquet(path)
    blocks = df.sparkSession.read.parquet(path)  # one row a block
    same = [at[k].eqNullSafe(blocks[k]) for k in keys]
    met = at.join(F.broadcast(blocks), same).select(*(at[c] for c in at.columns), "_before", "_first", "_dense")
    out = met.where("_dense").withColumn("record_index", F.col("_before") + F.col("_id") - F.col("_first") + 1)
    if blocks.where("not _dense").head(1):
        inside = Window.partitionBy(*keys).orderBy("_id")
        out = out.unionByName(met.where("not _dense").withColumn("record_index", F.col("_before") + F.row_number().over(inside)))
    return out.drop("_id", "_part", "_block", "_before", "_first", "_dense")


def replay_slice(df: DataFrame, start: int = 1, limit: int = 0) -> DataFrame:
    """Rows from ``start`` on, at most ``limit`` of them (0: all) by index and file; no task sees them all."""
    out = df.where(F.col("record_index") >= start)
    if limit <= 0:
        return out
    by = ["record_index", *(["source_file"] if "source_file" in df.columns else [])]
    return ranked(out, by, "_rank").where(F.col("_rank") <= limit).drop("_rank")


def _parsed(df: DataFrame, texts: list[str], wholes: list[str], numbers: list[str]) -> DataFrame:
    """Every cell trimmed once (``_c_`` + name; a missing one is blank), then every number parsed once (``_v_`` + name).

    ``_row`` keeps conditions on these above the parsing: pushed below it, each use would trim and parse anew.
    """
    cells = df.select("*", *((trimmed(f"`{c}`") if c in df.columns else F.lit("")).alias(f"_c_{c}") for c in (*texts, *wholes, *numbers)))
    return cells.select("*", F.monotonically_increasing_id().alias("_row"), *(whole(F.col(f"_c_{c}")).alias(f"_v_{c}") for c in wholes), *(number(F.col(f"_c_{c}")).alias(f"_v_{c}") for c in numbers))


def _cell(name: str) -> Column:
    return F.col(f"_c_{name}")


def _value(name: str) -> Column:
    return F.col(f"_v_{name}")


def _bad(name: str) -> Column:
    return (_cell(name) != "") & _value(name).isNull()


def _checked(rules: list[tuple[Column, str]]) -> list[Column]:
    """``is_valid`` as a plain condition, so that valid rows need no list, and the list of ``errors``."""
    return [((F.col("_row") >= 0) & ~any_of(*(bad for bad, _ in rules))).alias("is_valid"), reasons(*rules).alias("errors")]


def _envelope(df: DataFrame, op: str, match: Column, player: Column, event: Column, payload: Column, dataset_id: str, kind: str, now: Column | None) -> list[Column]:
    source = F.struct(F.lit("kaggle").alias("provider"), F.lit(dataset_id).alias("dataset_id"), F.lit(kind).alias("schema_type"), F.col("source_file"), F.col("record_index").cast("bigint").alias("record_index"))
    return [F.lit("1.0").alias("schema_version"), sha256(event).alias("event_id"), F.lit(op).alias("op"), F.lit(None).cast("string").alias("event_time"), (rfc3339_now() if now is None else now).alias("ingest_time"), sha256(match).alias("match_id"), sha256(player).alias("player_id"), source.alias("source"), payload.alias("payload")]


def _raw(df: DataFrame) -> Column:
    names = [c for c in df.columns if c not in SYSTEM and not c.startswith(("_c_", "_v_", "_row"))]
    return F.map_from_arrays(F.array(*(F.lit(c) for c in names)), F.array(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in names))).alias("raw_fields")


def normalize_player_stats(df: DataFrame, dataset_id: str, now: Column | None = None) -> DataFrame:
    """Envelope columns, ``is_valid``, ``errors`` and ``raw_fields`` of every finish-placement row."""
    df = _parsed(df, ["matchId", "Id"], ["kills", "headshotKills"], [*_STAT_CELLS.values(), "winPlacePerc"])
    match, player = _cell("matchId"), _cell("Id")
    rules: list[tuple[Column, str]] = [(match == "", "match_id_blank"), (player == "", "player_id_blank")]
    k, h = F.coalesce(_value("kills"), F.lit(0)), F.coalesce(_value("headshotKills"), F.lit(0))
    rules += [(_bad("kills"), "kills_invalid"), (k < 0, "kills_negative"), (_bad("headshotKills"), "headshot_kills_invalid"), (h < 0, "headshot_kills_negative"), ((h >= 0) & (h > k), "headshot_kills_over_kills")]
    values: dict[str, Column] = {"kills": k, "headshot_kills": h}
    for name, cell in _STAT_CELLS.items():
        v = _value(cell)
        values[name] = F.coalesce(v, F.lit(0.0))
        rules += [(_bad(cell), f"{name}_invalid"), (v < 0, f"{name}_negative"), (~finite(v), f"{name}_non_finite")]
    win = _value("winPlacePerc")
    rules += [(_bad("winPlacePerc"), "win_place_perc_invalid"), ((win < 0) | (win > 1), "win_place_perc_out_of_range")]
    payload = F.struct(*(values[c].alias(c) for c in ("kills", "damage_dealt", "headshot_kills", "walk_distance", "ride_distance", "swim_distance", "survival_duration")), win.alias("win_place_perc"))
    event = F.concat_ws(":", F.col("source_file"), match, F.col("record_index").cast("string"), player)
    return df.select(*_envelope(df, S.OP_MATCH_SUMMARY, match, player, event, payload, dataset_id, "finish_placement", now), *_checked(rules), _raw(df))


def normalize_kill_events(df: DataFrame, dataset_id: str, now: Column | None = None, identity: str = "canonical") -> DataFrame:
    """Envelope columns, ``is_valid``, ``errors`` and ``raw_fields`` of every kill row.

    ``identity="reference"`` keeps killer and victim names raw in the payload;
    ``"canonical"`` hashes them like player ids, so they can be joined.
    """
    places = ["killer_placement", "victim_placement"]
    df = _parsed(df, ["match_id", "killer_name", "victim_name", "killed_by"], places, [*_KILL_CELLS, "time"])
    df = df.withColumns({f"_v_{c}": _value(c).try_cast("int") for c in places})  # whole numbers only: "4.0" is an error
    match, killer, victim = (_cell(c) for c in ("match_id", "killer_name", "victim_name"))
    rules: list[tuple[Column, str]] = [(match == "", "match_id_blank"), ((killer == "") & (victim == ""), "killer_and_victim_blank")]
    rules += [(_bad(name), f"{name}_invalid") for name in places]
    for name in _KILL_CELLS:
        rules += [(_bad(name), f"{name}_invalid"), (~finite(_value(name)), f"{name}_non_finite")]
    time = _value("time")
    rules += [(_bad("time"), "time_invalid"), (time < 0, "time_negative"), (~finite(time), "time_non_finite")]
    name_of = (lambda c: sha256(F.nullif(c, F.lit("")))) if identity == "canonical" else (lambda c: F.nullif(c, F.lit("")))
    payload = F.struct(
        sha256(match).alias("match_id"), name_of(killer).alias("killer_name"), name_of(victim).alias("victim_name"),
        *(_value(c).alias(c) for c in (*places, *_KILL_CELLS)),
        time.alias("event_time_seconds"), F.nullif(_cell("killed_by"), F.lit("")).alias("weapon"),
    )
    player = F.when(killer != "", killer).otherwise(victim)
    event = F.concat_ws(":", F.col("source_file"), match, F.col("record_index").cast("string"), player, victim)
    return df.select(*_envelope(df, S.OP_KILL_RAW, match, player, event, payload, dataset_id, "match_deaths", now), *_checked(rules), _raw(df))


def normalize(df: DataFrame, dataset_id: str, now: Column | None = None, identity: str = "canonical") -> DataFrame:
    if detect_schema(df) == "match_deaths":
        return normalize_kill_events(df, dataset_id, now, identity)
    return normalize_player_stats(df, dataset_id, now)


def split_valid_invalid(df: DataFrame, failed_at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Envelopes without errors; rejects with their raw fields and errors."""
    good = df.where("is_valid").drop("is_valid", "errors", "raw_fields")
    bad = df.where("not is_valid").select(F.col("source.source_file").alias("source_file"), F.col("source.record_index").alias("record_index"), "raw_fields", F.col("errors").alias("validation_errors"), (rfc3339_now() if failed_at is None else failed_at).alias("failed_at"))
    return good, bad


def replay_statistics(df: DataFrame) -> DataFrame:
    """Rows read, valid, invalid; produced counts the valid ones that a sink would get."""
    valid = F.count_if("is_valid")
    return df.agg(F.count("*").alias("records_read"), valid.alias("records_valid"), F.count_if(~F.col("is_valid")).alias("records_invalid"), valid.alias("records_produced"))


def kill_death_stats(kills: DataFrame) -> DataFrame:
    """each kill as a player-stat row."""
    x, y = F.col("killer_position_x"), F.col("killer_position_y")
    zero = F.lit(0.0)
    return kills.select(
        "match_id", F.col("killer_name").alias("player_id"), F.lit(1).cast("bigint").alias("kills"), zero.alias("damage_dealt"), F.lit(0).cast("bigint").alias("headshot_kills"),
        F.coalesce(F.sqrt(x * x + y * y) / 1000, zero).alias("walk_distance"), zero.alias("ride_distance"), zero.alias("swim_distance"),
        F.coalesce("event_time_seconds", zero).alias("survival_duration"), F.try_divide(F.lit(1.0), F.col("killer_placement").cast("double")).alias("win_place_perc"),
    )
