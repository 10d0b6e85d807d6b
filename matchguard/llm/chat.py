"""Multi-party perspective rotation of dialogues.

For every participant of a conversation the whole dialogue is rendered with that
speaker as the assistant and all others as named users; the mask marks what the
assistant says and the sign that ends it. System turns are context in every
rendering and are no participant.

A rendering comes in pieces of at most ``turns_per_piece`` turns, so a
conversation of any length never meets in one string: pieces in order, joined,
are the dialogue, and ``char_start`` is a piece's place in it. The texts of at
most ``BLOCK`` numbered pieces meet in one task, of a whole conversation only
one row a block. Turns are grouped by their number first; only turns that repeat
one number in masses (or have none) are ordered together. All of it is DataFrame
operations.

Defined results: turns go by number, role, text, nulls first; a null text is
empty; a null or empty role speaks as ``unknown`` and is no participant, even
where a speaker is named so (that one's turns come after it in a tie); the
marks of the format are parted in texts and names, so no text forges a turn;
repeated rows are turns each; a null conversation is one more conversation; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Pieces whose rendered texts may meet in one task.
BLOCK = 256
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _safe(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"<\|", "< |"), r"\|>", "| >")


def _head(role: Column, name: Column, mine: Column) -> Column:
    speaker = F.when(mine, F.lit("assistant\n")).when(role == "system", F.lit("system\n")).otherwise(F.concat(F.lit("user name="), name, F.lit("\n")))
    return F.concat(F.lit(OPEN), speaker)


def rotate(conversations: DataFrame, turns_per_piece: int = 64) -> DataFrame:
    """``conv_id, participant, piece, sub_piece, n_turns, char_start, text, mask``.

    ``mask`` lists the trained spans of ``text`` as ``start:end`` pairs parted by
    spaces, in characters from the start of the piece.
    """
    role = F.coalesce(F.nullif("role", F.lit("")), F.lit("unknown"))
    known = F.coalesce(F.col("role") != "", F.lit(False))
    turns = conversations.select("conv_id", "turn", role.alias("role"), known.alias("known"), _safe(F.col("text")).alias("text"), _safe(role).alias("name"))
    turns = turns.withColumn("piece", F.coalesce(F.floor(F.col("turn") / turns_per_piece), F.lit(-1)).cast("long"))
    order = Window.partitionBy("conv_id", "piece").orderBy("turn", "role", "text", "known")
    turns = turns.withColumn("at", F.row_number().over(order)).withColumn("sub_piece", F.floor((F.col("at") - 1) / turns_per_piece).cast("long"))
    pieces = turns.groupBy("conv_id", "piece", "sub_piece").agg(F.array_sort(F.collect_list(F.struct("at", "role", "known", "name", "text"))).alias("turns"))

    speakers = conversations.where("role <> '' and role <> 'system'").select(F.col("conv_id").alias("c"), F.col("role").alias("participant")).distinct()
    each = pieces.join(speakers, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    me = F.col("participant")
    mine = lambda t: t["known"] & (t["role"] == me)
    said = F.transform("turns", lambda t: F.struct(_head(t["role"], t["name"], mine(t)).alias("head"), F.concat(t["text"], F.lit(CLOSE)).alias("body"), mine(t).alias("mine")))
    each = each.select("conv_id", "participant", "piece", "sub_piece", F.size("turns").alias("n_turns"), said.alias("said"))
    end = F.lit("\n")
    whole = F.array_join(F.transform("said", lambda t: F.concat(t["head"], t["body"], end)), "")
    # running start of each turn, then the spans of the assistant's bodies
    start = F.aggregate(
        "said",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans")),
        lambda acc, t: F.struct(
            (acc["at"] + F.length(t["head"]) + F.length(t["body"]) + 1).alias("at"),
            F.when(t["mine"], F.concat(acc["spans"], F.array(F.concat_ws(":", (acc["at"] + F.length(t["head"])).cast("string"), (acc["at"] + F.length(t["head"]) + F.length(t["body"])).cast("string"))))).otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: F.array_join(acc["spans"], " "),
    )
    rendered = each.select("conv_id", "participant", "piece", "sub_piece", "n_turns", whole.alias("text"), start.alias("mask"))
    # a piece's place: characters of earlier blocks of pieces, from a table of lengths, and of earlier pieces in its block
    block = F.floor(F.col("piece") / BLOCK).cast("long")
    size = F.aggregate("said", F.lit(0).cast("long"), lambda n, t: n + F.length(t["head"]) + F.length(t["body"]) + 1)
    sums = each.groupBy("conv_id", "participant", block.alias("block")).agg(F.sum(size).alias("chars"))
    earlier = Window.partitionBy("conv_id", "participant").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(F.col("conv_id").alias("c"), F.col("participant").alias("p"), F.col("block").alias("b"), F.coalesce(F.sum("chars").over(earlier), F.lit(0)).alias("block_start"))
    before = Window.partitionBy("conv_id", "participant", "block").orderBy("piece", "sub_piece").rowsBetween(Window.unboundedPreceding, -1)
    met = rendered.withColumn("block", block).join(starts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("participant") == F.col("p")) & (F.col("block") == F.col("b")))
    placed = met.withColumn("char_start", F.col("block_start") + F.coalesce(F.sum(F.length("text").cast("long")).over(before), F.lit(0)))
    return placed.select("conv_id", "participant", "piece", "sub_piece", "n_turns", "char_start", "text", "mask")


#: The same rows in DuckDB, for 64 turns a piece.
SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(nullif(role, ''), 'unknown') AS role, coalesce(role <> '', false) AS known,
         replace(replace(coalesce(text, ''), '<|', '< |'), '|>', '| >') AS text,
         replace(replace(coalesce(nullif(role, ''), 'unknown'), '<|', '< |'), '|>', '| >') AS name,
         coalesce(CAST(floor(turn / 64) AS BIGINT), -1) AS piece
  FROM conversations
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, piece ORDER BY turn NULLS FIRST, role, text, known) AS pos FROM turns
), speakers AS (
  SELECT DISTINCT conv_id, role AS participant FROM conversations WHERE role <> '' AND role <> 'system'
), said AS (
  SELECT n.conv_id, participant, piece, CAST(floor((pos - 1) / 64) AS BIGINT) AS sub_piece, pos, known AND role = participant AS mine,
         '<|im_start|>' || CASE WHEN known AND role = participant THEN 'assistant' || chr(10) WHEN role = 'system' THEN 'system' || chr(10)
                                ELSE 'user name=' || name || chr(10) END AS head,
         text || '<|im_end|>' AS body
  FROM numbered n JOIN speakers s ON n.conv_id IS NOT DISTINCT FROM s.conv_id
), placed AS (
  SELECT *, sum(length(head) + length(body) + 1) OVER w - length(body) - 1 AS a FROM said
  WINDOW w AS (PARTITION BY conv_id, participant, piece, sub_piece ORDER BY pos)
), pieces AS (
  SELECT conv_id, participant, piece, sub_piece, CAST(count(*) AS INTEGER) AS n_turns,
         string_agg(head || body || chr(10), '' ORDER BY pos) AS text,
         coalesce(string_agg(CAST(CAST(a AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(a + length(body) AS BIGINT) AS VARCHAR), ' ' ORDER BY pos) FILTER (WHERE mine), '') AS mask
  FROM placed GROUP BY conv_id, participant, piece, sub_piece
)
SELECT conv_id, participant, piece, sub_piece, n_turns,
       CAST(coalesce(sum(length(text)) OVER (PARTITION BY conv_id, participant ORDER BY piece, sub_piece
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS char_start, text, mask
FROM pieces
"""
