"""Spelling variants: words one edit apart, grouped under their frequent form.

Words are counted map-side, in each task's own table that is given out whenever
it holds ``HELD`` words, and the counts are added up.

Near words (one code point inserted, deleted or replaced) come from a scan of
sorted lists. A word's edit matrix is kept to the band of three columns around
the diagonal, one row a character of the listed word; the next word of the list
takes over the rows of the prefix that it shares with the one before, and once no
cell of a row is below two, all words that share that prefix are skipped.

A list holds the words that may be near by pigeonhole: with the place of the
first difference in a span of the shorter word, all before the span and all
behind it is equal. Words begin with two spans, the halves; a list of more than
``LIST`` words is cut into lists of half the span, until it is short or the span
is one place, where no more words can differ than an alphabet's pairs. Each near
pair has one first difference and one shorter length, so it is found in exactly
one list. No list grows with the corpus.

Defined results: null and empty texts have no words; a null id is drawn as the
empty text; texts and words of any length are read whole; ties of counts go to
the smaller word in code-point order; repeated rows count again; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, is_empty, join_spread, materialize

#: Letters of a word, and the only ones that are lower-cased.
LETTERS = "A-Za-zÀ-ÿ"
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: Words that a task holds before it gives out their counts, and matches taken at once of a long text.
HELD, TAKEN = 300_000, 1 << 16
#: Words of a list, above which its span is cut in two.
LIST = 2048


def _runs(pattern: re.Pattern, text: str) -> Iterator[Counter]:
    if len(text) < 1 << 20:
        yield Counter(pattern.findall(text))
        return
    matches = pattern.finditer(text)
    while chunk := Counter(m.group() for m in islice(matches, TAKEN)):
        yield chunk


def _tally(min_len: int, typos: int | None):
    pattern = re.compile(f"[{LETTERS}]{{{min_len},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not text:
                    continue
                seed = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for runs in _runs(pattern, text):
                    for run, n in runs.items():
                        word = run.lower() if run.isascii() else run.translate(_LOWER)
                        if typos:
                            h = zlib.crc32(word.encode(), seed)
                            if not h % typos:
                                at = h % len(word)
                                word = word[:at] + word[at + 1 :]
                                if len(word) < min_len:
                                    continue
                        held[word] += n
                if len(held) >= HELD:
                    yield out()
                    held.clear()
        if held:
            yield out()

    return run


def count_words(docs: DataFrame, min_len: int = 6, min_count: int = 5, typos: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n`` of words of at least ``min_len`` code points (1 or more) with at least ``min_count`` occurrences.

    ``typos`` plants misspellings to try the grouping on: of the draws of a
    document and a word that this number divides, the word loses a code point.
    """
    named = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    parts = named.mapInArrow(_tally(min_len, typos), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def near_in_list(words: list[str], base: int, low: int, high: int) -> Iterator[tuple[int, int]]:
    """Pairs of places of different, sorted words with one edit between them, whose shorter length is ``base`` and whose first difference is at ``low`` to ``high`` - 1."""
    if low >= high:
        return
    m = len(words)
    lcp = [0] * (m + 1)  # lcp[j]: what word j shares with the one before; nothing behind the last
    for j in range(1, m):
        a, b = words[j - 1], words[j]
        k = low if a[:low] == b[:low] else 0
        end = min(len(a), len(b))
        while k < end and a[k] == b[k]:
            k += 1
        lcp[j] = k
    lower, stack = [m] * (m + 1), []  # lower[j]: the next place that shares less
    for j in range(m + 1):
        while stack and lcp[stack[-1]] > lcp[j]:
            lower[stack.pop()] = j
        stack.append(j)
    for i in range(m - 1):
        query = words[i]
        size, padded = len(query), f"\0{query}\1\1\1"
        j = i + 1
        shared = lcp[j]
        depth = shared
        rows = [(1, 0, 1)] * (depth + 1)  # equal prefixes; at depth d the columns d - 1, d, d + 1
        rows[0] = (2, 0, 1)
        while j < m:
            shared = min(shared, lcp[j])
            if shared < low:
                break
            if shared >= high:  # the first difference lies in another list's span
                while lcp[j] >= high:
                    j = lower[j]
                depth = min(depth, lcp[j])
                continue
            depth = min(depth, lcp[j])
            del rows[depth + 1 :]
            x, y, z = rows[depth]
            word = words[j]
            n, d = len(word), depth
            while d < n:
                c = word[d]
                nx = x + (c != padded[d])
                ny = y + (c != padded[d + 1])
                nz = z + (c != padded[d + 2])
                if y + 1 < nx:
                    nx = y + 1
                if z + 1 < ny:
                    ny = z + 1
                if nx + 1 < ny:
                    ny = nx + 1
                if ny + 1 < nz:
                    nz = ny + 1
                x, y, z = nx, ny, nz
                d += 1
                if x > 1 and y > 1 and z > 1:
                    break
                rows.append((x, y, z))
            depth = d
            if x > 1 and y > 1 and z > 1:  # no word with this prefix is near
                rows.append((x, y, z))
                j += 1
                while lcp[j] >= d:
                    j = lower[j]
                continue
            apart = size - n
            if -1 <= apart <= 1 and (x, y, z)[apart + 1] == 1 and min(size, n) == base:
                yield i, j
            j += 1


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by list, in order (key, base, low, high, word, n) -> of each word with near ones: how many, the largest count, and the least word of that count."""
    now, words, counts = None, [], []

    def solve() -> list[tuple[str, int, int, str]]:
        found: dict[int, list] = {}
        for i, j in near_in_list(words, *now[1:]):
            for a, b in ((i, j), (j, i)):
                held = found.setdefault(a, [0, 0, ""])
                held[0] += 1
                if counts[b] > held[1] or counts[b] == held[1] and words[b] < held[2]:
                    held[1:] = counts[b], words[b]
        return [(words[a], *held) for a, held in found.items()]

    def out(done: list[tuple]) -> pa.RecordBatch:
        word, near, n, best = zip(*done, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(near, pa.int64()), pa.array(n, pa.int64()), pa.array(best, pa.string())], names=["word", "near", "best_n", "best"])

    for batch in batches:
        done = []
        for *head, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if head != now:
                if len(words) > 1:
                    done += solve()
                now, words, counts = head, [], []
            words.append(word)
            counts.append(n)
        if done:
            yield out(done)
    if len(words) > 1 and (done := solve()):
        yield out(done)


def _spans(*spans) -> F.Column:
    return F.array(*(F.struct(F.col("base"), F.expr(a).cast("int").alias("low"), F.expr(b).cast("int").alias("high")) for a, b in spans))


def _keyed(rows: DataFrame) -> DataFrame:
    """Adds the list of a word and a span: what lies before the span and behind it in the shorter word."""
    behind = F.col("base") - F.col("high")
    tail = F.when(behind > 0, F.expr("substring(word, char_length(word) - (base - high) + 1, base - high)")).otherwise("")
    return rows.withColumn("key", F.xxhash64("base", "low", "high", F.expr("substring(word, 1, low)"), tail))


def _lists(words: DataFrame, most: int) -> DataFrame:
    """``key, base, low, high, word, n``: every word in the lists that can hold its near words, none longer than ``most`` unless its span is one place."""
    rows = words.withColumn("base", F.explode(F.expr("array(char_length(word), char_length(word) - 1)"))).where("base > 0")
    halves = _spans(("0", "base div 2"), ("base div 2", "base + 1"))
    rows = _keyed(rows.withColumn("span", F.explode(halves)).where("span.low < span.high").select("word", "n", "span.*"))
    done: DataFrame | None = None
    while True:
        rows = materialize(rows.select("key", "base", "low", "high", "word", "n"), "spelling-lists")
        long = rows.groupBy("key").agg(F.count("*").alias("_n"), F.max(F.col("high") - F.col("low")).alias("_w")).where((F.col("_n") > most) & (F.col("_w") > 1)).select("key", F.lit(True).alias("long"))
        long = materialize(long, "spelling-long")  # fewer than one key in ``most`` rows
        if is_empty(long):
            return rows if done is None else done.unionByName(rows)
        marked = join_spread(rows, long, "key", "word")
        short = marked.where(F.col("long").isNull() | (F.col("high") - F.col("low") < 2)).drop("long")
        done = short if done is None else done.unionByName(short)
        middle = "(low + high) div 2"
        cut = marked.where(F.col("long") & (F.col("high") - F.col("low") > 1)).withColumn("span", F.explode(_spans(("low", middle), (middle, "high"))))
        rows = _keyed(cut.select("word", "n", "span.*"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root``: from each word of ``forms`` (word, form) to the last form, by jumps of doubling length; counts rise along forms, so there is no ring."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = now.select(F.col("word").alias("at"), F.col("root").alias("next"))
        moved = materialize(now.join(step, F.col("root") == F.col("at"), "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        discard(now)
        now = moved.select("word", "root")
        now._scratch_path = moved._scratch_path
        if is_empty(moved.where("moved")):
            return now


def group_variants(words: DataFrame, ratio: int = 5, most: int = LIST) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of different, not empty ``words`` (word, n).

    The form is the near word of largest count, if that is at least ``ratio`` times the word's.
    """
    words = materialize(words.select("word", F.col("n").cast("long").alias("n")), "spelling-words")
    lists = _lists(words, most).repartition("key").sortWithinPartitions("key", "base", "low", "high", "word").select("key", "base", "low", "high", "word", "n")
    near = lists.mapInArrow(_near, "word string, near long, best_n long, best string")
    best = near.groupBy(F.col("word").alias("w")).agg(F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("top"))
    form = (-F.col("top.less") >= ratio * F.col("n"))
    joined = words.join(best, F.col("word") == F.col("w"), "left")
    met = materialize(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(form, F.col("top.best")).alias("form"), F.when(form, -F.col("top.less")).alias("form_n")), "spelling-met")
    roots = _roots(met.where("form is not null").select("word", "form")).withColumnRenamed("word", "w")
    out = met.join(roots, F.col("word") == F.col("w"), "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: The same rows in DuckDB, for the parameters of the query: near words share what is left when one code point goes.
SQL = r"""
WITH RECURSIVE bits AS (
  SELECT i, i AS c, 0 AS k FROM range(256) r(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), crc AS (
  SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents
), counted AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n FROM runs GROUP BY ALL
), bytes AS (
  SELECT run, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS b FROM counted WHERE length(run) >= 6
), hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(0, length(b) // 2), lambda i: CAST('0x' || substr(b, 2 * i + 1, 2) AS BIGINT))),
                                 lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS h
  FROM bytes, crc
), spelled AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelled WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), cuts AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)
), pairs AS (
  SELECT a.word, b.word AS near, b.n FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM words a JOIN cuts b ON a.word = b.rest
  UNION
  SELECT b.word, a.word, a.n FROM words a JOIN cuts b ON a.word = b.rest
), best AS (
  SELECT word, count(*) AS n_near, list_sort(list({'less': -n, 'near': near}))[1] AS top FROM pairs GROUP BY word
), met AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -top.less >= 5 * w.n THEN top.near END AS form, CASE WHEN -top.less >= 5 * w.n THEN -top.less END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word
), walk AS (
  SELECT word, word AS at FROM met
  UNION ALL
  SELECT k.word, m.form FROM walk k JOIN met m ON k.at = m.word WHERE m.form IS NOT NULL
)
SELECT m.word, m.form, k.at AS root, m.n, m.n_near, m.form_n
FROM met m JOIN walk k ON m.word = k.word JOIN met e ON k.at = e.word WHERE e.form IS NULL
"""
