"""Conversation structure repair by iterative-deepening A*.

Faults of a conversation (missing turns, blank, repeated and cut-off rows, roles
that may not follow each other) are counted, and the cheapest edits are searched
that leave no blank or repeated row and roles of the form ``(s?(ua)+)?``: an
optional system row, then user and assistant in turn. A depth-first search
tries edits in ASCII order of their initials (Delete, Insert, Keep, Rerole)
under a bound of the total cost that grows to the least value that exceeded it;
states that failed are kept with a lower bound of what they still cost
(the transposition table), so the first accepting path is the cheapest and,
among those, the least in ASCII order.

A search sees one byte a row (who speaks, and the fault), never a text. Rows
come to it in order, as narrow rows without their texts; the texts are read
once, in order, behind the edits of their conversation, and go into the digest
one at a time. So no task holds the texts of a conversation. Equal rows of a turn
are one row with a count, and repeats are found by a grouped minimum, not by a
set of a conversation's rows. An audit and a digest are one value for a whole
conversation, so its rows must pass through one task: a hot conversation costs
time there, one byte a row and the table of its search, not the memory of its texts.

Defined results: null roles and texts are one space, and so are null ids and
turns where the damage is drawn; rows go by turn (nulls first), role and the
SHA-256 of the text; an empty role has no initial and must be edited; a null
conversation is one more conversation; one without rows has zeros, an empty
audit and the digest of nothing; repeated rows are duplicates; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3
WHITE = " \t\n\x0b\x0c\r"

# What has been said last: nothing, the system, the user, the assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Whom an inserted or rerolled row then names.
_NEXT = (USER, USER, ASSISTANT, USER)
_ENDS = (START, ASSISTANT)
# A row in one byte: who speaks (0 nobody of use, else as above), 4 if its text is cut off, 8 if it must go.
_CUT, _GONE = 4, 8
_LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}


def _fits(state: int, who: int) -> bool:
    return (state, who) in _LEGAL or state == START and who in (SYSTEM, USER)


def _edits(row: int | None, state: int) -> list[tuple[str, int, int, int]]:
    """Edits that a state allows before ``row`` (None: behind the last), in ASCII order: initial, rows taken, new state, cost."""
    add = ("I", 0, _NEXT[state], INSERT)
    if row is None:
        return [add]
    out, penalty = [("D", 1, state, DELETE), add], CUT if row & _CUT else 0
    if not row & _GONE:
        if _fits(state, row & 3):
            out.append(("K", 1, row & 3, KEEP + penalty))
        out.append(("R", 1, _NEXT[state], REROLE + penalty))
    return out


_TABLE = {row: [_edits(row, s) for s in range(4)] for row in (None, *range(16))}


def lower_bounds(rows: bytes) -> list[int]:
    """For each place a cost that the rows from there on need at least, whatever was said before.

    Rows that must go cost a deletion and cut-off rows their penalty. Beyond
    that, a row of a useless role needs an edit, and so do two neighbours among
    the staying rows that may not follow each other (one of them, or between
    them); the largest sum over such places that share no row is added.
    """
    out, forced = [0] * (len(rows) + 1), 0
    best, without, after = 0, 0, None  # sums from the next staying row on, and from behind it
    for i in range(len(rows) - 1, -1, -1):
        row = rows[i]
        if row & _GONE:
            forced += DELETE
        else:
            forced += CUT if row & _CUT else 0
            who, total = row & 3, best
            if not who:
                total += DELETE - CUT if row & _CUT else REROLE
            elif after is not None and after & 3 and (who, after & 3) not in _LEGAL:
                total = max(total, without + (DELETE - CUT if (row | after) & _CUT else REROLE))
            best, without, after = total, best, row
        out[i] = forced + best
    return out


def _descend(rows: bytes, left: list[int], start: int, goal: int | None = None) -> str | None:
    """One depth-first search from node ``start`` (four times a place, and a state) under the bound of what it still costs at least.

    ``left`` is the transposition table: by node the least that is still to pay,
    raised where a search fails. Without ``goal`` a search ends where all rows
    are taken and the roles are whole; with it, at that place, whose entries are exact.
    """
    n, bound = len(rows), left[start]
    at, spent, tried, least, audit = [start], [0], [0], [1 << 60], []
    while at:
        node, g = at[-1], spent[-1]
        place, state = node >> 2, node & 3
        if not tried[-1] and (place == n and state in _ENDS if goal is None else place >= goal):
            return "".join(audit)
        edits = _TABLE[rows[place] if place < n else None][state]
        for t in range(tried[-1], len(edits)):
            name, taken, to, cost = edits[t]
            child = (place + taken) << 2 | to
            if g + cost + left[child] <= bound:
                tried[-1] = t + 1
                at.append(child)
                spent.append(g + cost)
                tried.append(0)
                least.append(1 << 60)
                audit.append(name)
                break
            least[-1] = min(least[-1], cost + left[child])
        else:
            left[node] = max(left[node], least[-1])
            for stack in (at, spent, tried, least):
                stack.pop()
            if at:
                audit.pop()
                least[-1] = min(least[-1], g - spent[-1] + left[node])
    return None


#: Rows between the places of a long conversation whose entries are made exact first, from its end on.
STRETCH = 64


def search(rows: bytes) -> tuple[int, str]:
    """The least cost and the ASCII-least initials of edits of that cost.

    The same deepening search first fills the table at every ``STRETCH`` rows,
    the last ones first, and the bounds of a stretch begin from there: so a
    bound never misses by more than what one stretch hides, and the time for a
    long conversation grows with its length.
    """
    left = [0] * (4 * len(rows)) + [0, 2 * INSERT, INSERT, 0]
    goal = len(rows)
    while goal:
        place, floor = max(0, goal - STRETCH), min(left[4 * goal : 4 * goal + 4])
        left[4 * place : 4 * goal] = [b + floor for b in lower_bounds(rows[place:goal])[:-1] for _ in range(4)]
        if place:
            for node in range(4 * place, 4 * place + 4):
                while _descend(rows, left, node, goal) is None:
                    pass
        goal = place
    while (audit := _descend(rows, left, START)) is None:
        pass
    return left[START], audit


FAULTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
#: Audits of this many different short conversations are kept by a task.
MEMO, MEMO_ROWS = 50_000, 32


class _Faults:
    """Counts of one conversation, fed with its rows in order."""

    def __init__(self, conv):
        self.conv, self.rows = conv, bytearray()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.who = None

    def add(self, turn: int | None, who: int, blank: bool, again: bool, cut: bool, copies: int) -> None:
        if not copies:
            return
        if turn is not None:
            self.first = turn if self.first is None else self.first
            self.turns += turn != self.last
            self.last = turn
        self.illegal += (self.who is not None and (self.who, who) not in _LEGAL) + copies - 1
        self.who = who
        if blank:
            self.blank += copies
            self.rows += bytes([who | _GONE]) * copies
            return
        self.duplicate += copies - (not again)
        if not again:
            self.truncated += cut
            self.rows.append(who | (_CUT if cut else 0))
            copies -= 1
        self.rows += bytes([who | _GONE]) * copies

    def result(self, memo: dict) -> tuple:
        rows = bytes(self.rows)
        found = memo.get(rows)
        if found is None:
            found = search(rows)
            if len(rows) <= MEMO_ROWS and len(memo) < MEMO:
                memo[rows] = found
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, *found


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by conversation, in order (conv_id, turn, who, blank, again, cut, copies) -> one row a conversation: its counts, cost and audit."""
    now, memo, kind = None, {}, None

    def out(done: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*done, strict=True))
        arrays = [pa.array(columns[0], kind), *(pa.array(c, pa.int64()) for c in columns[1:7]), pa.array(columns[7], pa.string())]
        return pa.RecordBatch.from_arrays(arrays, names=["conv_id", *FAULTS, "audit"])

    for batch in batches:
        done, kind = [], batch.schema.field(0).type
        for conv, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or conv != now.conv:
                if now is not None:
                    done.append(now.result(memo))
                now = _Faults(conv)
            now.add(*row)
        if done:
            yield out(done)
    if now is not None:
        yield out([now.result(memo)])


class _Repair:
    """The digest of one repaired conversation, fed with its rows in order."""

    def __init__(self, head: tuple, audit: str):
        self.head, self.audit, self.at, self.state, self.any, self.sha = head, audit, 0, START, False, hashlib.sha256()

    def _write(self, role: str, text: str) -> None:
        self.sha.update((f"\n{role}:{text}" if self.any else f"{role}:{text}").encode())
        self.any = True

    def _named(self) -> str:
        self.state = _NEXT[self.state]
        return "user" if self.state == USER else "assistant"

    def _insert(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._write(self._named(), "")
            self.at += 1

    def add(self, role: str, text: str, who: int, copies: int) -> None:
        for _ in range(copies):
            self._insert()
            edit = self.audit[self.at]
            self.at += 1
            if edit == "K":
                self.state = who
                self._write(role, text)
            elif edit == "R":
                self._write(self._named(), text)

    def result(self) -> tuple:
        self._insert()
        return *self.head, self.audit, self.sha.hexdigest()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each conversation its row of counts, then its texts in order (conv_id, role, text, who, copies, counts...) -> counts, audit and digest."""
    now, kind = None, None

    def out(done: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*done, strict=True))
        arrays = [pa.array(columns[0], kind), *(pa.array(c, pa.int64()) for c in columns[1:7]), *(pa.array(c, pa.string()) for c in columns[7:])]
        return pa.RecordBatch.from_arrays(arrays, names=["conv_id", *FAULTS, "audit", "repaired_sha256"])

    for batch in batches:
        done, kind = [], batch.schema.field(0).type
        for conv, role, text, who, copies, *counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if role is None:  # the head of a conversation, whose text is the audit
                if now is not None:
                    done.append(now.result())
                now = _Repair((conv, *counts), text)
            else:
                now.add(role, text, who, copies)
        if done:
            yield out(done)
    if now is not None:
        yield out([now.result()])


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies``: rows with faults planted by a draw of their conversation and turn, to try a repair on.

    Of twenty draws 0 drops a row (no copies), 1 empties its text, 2 takes its
    sentence ends away, 3 repeats it, 4 gives it to the user.
    """
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat_ws(":", known("conv_id"), known("turn")).cast("binary")) % 20
    drawn = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), known("role").alias("role"), known("text").alias("text"), draw.alias("draw"))
    text = F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("draw") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("draw") == 0, 0).when(F.col("draw") == 3, 2).otherwise(1)
    return drawn.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.cast("long").alias("copies"))


def repair(turns: DataFrame) -> DataFrame:
    """Per conversation of ``turns`` (conv_id, turn, role, text, copies; a row with 0 copies only names its conversation):
    ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``."""
    initial = F.substring("role", 1, 1)
    who = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(0)
    bare = F.rtrim("text", F.lit(WHITE))
    rows = turns.select("conv_id", "turn", "role", "text", "copies", F.unhex(F.sha2("text", 256)).alias("digest"), who.alias("who"))
    said = rows.select("conv_id", "turn", "role", "digest", "who", "copies", (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    kept = said.groupBy("conv_id", "turn", "role", "digest", "who").agg(F.sum("copies").alias("copies"), F.max("blank").alias("blank"), F.max("cut").alias("cut"))
    # texts that a speaker says at several turns: all but the first are repeats
    firsts = kept.where("copies > 0").groupBy("conv_id", "role", "digest").agg(F.min("turn").alias("least"), F.max(F.col("turn").isNull()).alias("unnumbered"), F.count("*").alias("n")).where("n > 1")
    firsts = firsts.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "least", "unnumbered")
    met = kept.join(firsts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d")), "left")
    again = F.coalesce(F.col("turn").isNotNull() & (F.col("unnumbered") | (F.col("turn") > F.col("least"))), F.lit(False))
    order = ["conv_id", "turn", "role", "digest"]
    narrow = met.withColumn("again", again).repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "turn", "who", "blank", "again", "cut", "copies")
    conv = turns.schema["conv_id"].dataType.simpleString()
    counts = ", ".join(f"{c} long" for c in FAULTS)
    audits = narrow.mapInArrow(_audits, f"conv_id {conv}, {counts}, audit string")
    heads = audits.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("binary").alias("digest"), F.col("audit").alias("text"), F.lit(0).alias("who"), F.lit(0).cast("long").alias("copies"), *FAULTS)
    texts = rows.where("copies > 0").select("conv_id", F.lit(1).alias("kind"), "turn", "role", "digest", "text", "who", "copies", *(F.lit(None).cast("long").alias(c) for c in FAULTS))
    both = heads.unionByName(texts).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "digest")
    return both.select("conv_id", "role", "text", "who", "copies", *FAULTS).mapInArrow(_digests, f"conv_id {conv}, {counts}, audit string, repaired_sha256 string")


#: The same rows in DuckDB: the least edits of each rest of a conversation, from its end on.
SQL = r"""
WITH RECURSIVE bits AS (
  SELECT i, i AS c, 0 AS k FROM range(256) r(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), crc AS (
  SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8
), drawn AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations
), hashed AS (
  SELECT conv_id, turn, role, text,
         xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(name) + 1), lambda i: CAST(ascii(substr(name, i, 1)) AS BIGINT))),
                         lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS h
  FROM drawn, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
         CASE h WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE h WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM hashed
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS pos,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS said,
         rtrim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') AS bare,
         CASE left(role, 1) WHEN 's' THEN 1 WHEN 'u' THEN 2 WHEN 'a' THEN 3 ELSE 0 END AS who
  FROM damaged
), rowed AS (
  SELECT *, bare = '' AS blank, bare <> '' AND said > 1 AS again, bare <> '' AND said = 1 AND right(bare, 1) NOT IN ('.', '!', '?') AS cut,
         lag(who) OVER (PARTITION BY conv_id ORDER BY pos) AS before
  FROM ordered
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (again) AS duplicate,
         count(*) FILTER (cut) AS truncated, count(*) FILTER (before IS NOT NULL AND (before, who) NOT IN ((1, 2), (2, 3), (3, 2))) AS illegal, count(*) AS n
  FROM rowed GROUP BY conv_id
), best AS (
  SELECT conv_id, n AS pos, {'c': 0, 'a': ''} AS b0, {'c': 6, 'a': 'II'} AS b1, {'c': 3, 'a': 'I'} AS b2, {'c': 0, 'a': ''} AS b3 FROM counted
  UNION ALL
  SELECT conv_id, pos,
         list_sort([e0, {'c': 3 + e2.c, 'a': 'I' || e2.a}, {'c': 6 + e3.c, 'a': 'II' || e3.a}])[1], list_sort([e1, {'c': 3 + e2.c, 'a': 'I' || e2.a}, {'c': 6 + e3.c, 'a': 'II' || e3.a}])[1],
         list_sort([e2, {'c': 3 + e3.c, 'a': 'I' || e3.a}])[1], list_sort([e3, {'c': 3 + e2.c, 'a': 'I' || e2.a}])[1]
  FROM (
    SELECT conv_id, pos,
           list_sort([d0, CASE WHEN gone THEN d0 ELSE r2 END, CASE WHEN gone OR who NOT IN (1, 2) THEN d0 WHEN who = 1 THEN {'c': p + b1.c, 'a': 'K' || b1.a} ELSE {'c': p + b2.c, 'a': 'K' || b2.a} END])[1] AS e0,
           list_sort([d1, CASE WHEN gone THEN d1 ELSE r2 END, CASE WHEN gone OR who <> 2 THEN d1 ELSE {'c': p + b2.c, 'a': 'K' || b2.a} END])[1] AS e1,
           list_sort([d2, CASE WHEN gone THEN d2 ELSE r3 END, CASE WHEN gone OR who <> 3 THEN d2 ELSE {'c': p + b3.c, 'a': 'K' || b3.a} END])[1] AS e2,
           list_sort([d3, CASE WHEN gone THEN d3 ELSE r2 END, CASE WHEN gone OR who <> 2 THEN d3 ELSE {'c': p + b2.c, 'a': 'K' || b2.a} END])[1] AS e3
    FROM (
      SELECT b.conv_id, b.pos - 1 AS pos, b0, b1, b2, b3, who, blank OR again AS gone, CASE WHEN cut THEN 3 ELSE 0 END AS p,
             {'c': 4 + b0.c, 'a': 'D' || b0.a} AS d0, {'c': 4 + b1.c, 'a': 'D' || b1.a} AS d1, {'c': 4 + b2.c, 'a': 'D' || b2.a} AS d2, {'c': 4 + b3.c, 'a': 'D' || b3.a} AS d3,
             {'c': 3 + p + b2.c, 'a': 'R' || b2.a} AS r2, {'c': 3 + p + b3.c, 'a': 'R' || b3.a} AS r3
      FROM best b JOIN rowed w ON w.conv_id IS NOT DISTINCT FROM b.conv_id AND w.pos = b.pos
    )
  )
), audited AS (
  SELECT conv_id, b0.c AS cost, b0.a AS audit FROM best WHERE pos = 0
), edits AS (
  SELECT conv_id, p, substr(audit, p, 1) AS edit, length(replace(substr(audit, 1, p), 'I', '')) AS pos, length(replace(substr(audit, 1, p), 'D', '')) AS place
  FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS p FROM audited)
), written AS (
  SELECT e.conv_id, place, edit, role, text, max(CASE WHEN place = 1 AND edit = 'K' AND who = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id) AS opened
  FROM edits e LEFT JOIN rowed w ON edit <> 'I' AND w.conv_id IS NOT DISTINCT FROM e.conv_id AND w.pos = e.pos
  WHERE edit <> 'D'
), texts AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - opened) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY place) AS text
  FROM written GROUP BY conv_id
)
SELECT i.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
       CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(t.text, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i
LEFT JOIN counted n ON n.conv_id IS NOT DISTINCT FROM i.conv_id
LEFT JOIN audited a ON a.conv_id IS NOT DISTINCT FROM i.conv_id
LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM i.conv_id
"""
