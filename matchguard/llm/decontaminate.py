"""Benchmark decontamination: block-max WAND over a BM25 index of test items.

Test items, cut into segments of at most 48 words, form an inverted index whose
impacts are BM25 weights as a share of the segment's own best score, so one
threshold holds for all. Every passage of every training document (64 words,
each 32 words) queries it; all segments at or above the threshold are found:

1. pivot: terms by rising greatest impact; while their sum stays below the
   threshold no segment that has only them can reach it;
2. block bound: the other terms' greatest impacts in each block of segments,
   plus that sum; blocks below the threshold are skipped;
3. the rest is scored exactly.

The steps run on arrays over many passages at once. A hit is verified on the
words around the passage: at least half of the three-word sequences of the
item's question, and at least half of the words of its answer. The question is
all but the last sentence, the answer the last (of one sentence: three quarters
and a quarter of the words).

The index is broadcast in pieces of at most ``piece_bytes`` of item text, a
bound that holds for any benchmark; each piece costs one pass over the texts.
An item longer than that has a piece of its own. Document frequencies and the
mean length are those of all items, counted in Spark first where there are
several pieces, so scores do not depend on the cut. Texts and items of any
length are searched whole.

Defined results: null and empty texts have no hits; null and empty items find
nothing; repeated items give a hit each; rows that repeat are searched each; an
empty table, either one, gives no hits; extra columns are not read, or kept
where rows are filtered.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize, slices, strings

WORD = re.compile(r"\w+")
SEGMENT, WINDOW, STRIDE, BLOCK = 48, 64, 32, 8
K1, B = 1.2, 0.75
HITS = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    parts = [w for w in (words_of(s) for s in re.split(r"(?<=[.!?])\s+|\n+", text)) if w]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    w = parts[0] if parts else []
    cut = len(w) - len(w) // 4
    return w[:cut], w[cut:]


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of each run, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _shares(grams: list, held: set) -> float:
    return sum(g in held for g in grams) / len(grams) if grams else 1.0


def segments(words: list[str]) -> list[list[str]]:
    """Parts of about equal length, of at most SEGMENT words."""
    n = -(-len(words) // SEGMENT)
    size = -(-len(words) // n) if n else 1
    return [words[a : a + size] for a in range(0, len(words), size)]


@dataclass
class Statistics:
    """Segments that hold each term, all segments, their mean length."""

    df: dict[str, int]
    n: int
    mean: float

    @classmethod
    def of(cls, parts: list[list[str]]) -> Statistics:
        return cls(Counter(t for w in parts for t in set(w)), len(parts), sum(map(len, parts)) / max(1, len(parts)))


class Index:
    """Inverted index of items with the greatest impact of each term, in all and by block.

    ``known`` has the statistics of all items where these are a part of them.
    """

    def __init__(self, items: list[tuple[int, str]], known: Statistics | None = None):
        self.items, entries = [], []
        for item_id, text in items:
            w = words_of(text)
            if not w:
                continue
            entries += [(len(self.items), part) for part in segments(w)]
            question, answer = question_and_answer(text)
            self.items.append((item_id, question, answer, len(w)))
        self.item_of = np.array([i for i, _ in entries], np.int64)
        self.n_entries, self.n_blocks = len(entries), -(-len(entries) // BLOCK)
        known = known or Statistics.of([w for _, w in entries])
        df, n_all, mean = known.df, known.n, known.mean
        self.terms = {t: i for i, t in enumerate(sorted({t for _, w in entries for t in w}))}
        rows = []
        for e, (_, w) in enumerate(entries):
            tf = Counter(w)
            weight = {t: np.log1p((n_all - df[t] + 0.5) / (df[t] + 0.5)) * c * (K1 + 1) / (c + K1 * (1 - B + B * len(w) / mean)) for t, c in tf.items()}
            best = sum(weight.values())
            rows += [(self.terms[t], e, x / best) for t, x in weight.items()]
        rows.sort()
        term, entry, impact = (np.array(x) for x in zip(*rows)) if rows else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        n = len(self.terms)
        self.at, self.entry, self.impact = np.searchsorted(term, np.arange(n + 1)), entry, impact
        self.top = np.maximum.reduceat(impact, self.at[:-1]) if n else np.zeros(0)
        key = term * max(1, self.n_blocks) + entry // BLOCK
        first = np.flatnonzero(np.diff(key, prepend=-1))
        self.block = (entry // BLOCK)[first]
        self.block_top = np.maximum.reduceat(impact, first) if n else np.zeros(0)
        self.block_at = np.searchsorted(term[first], np.arange(n + 1))

    def search(self, passage: np.ndarray, term: np.ndarray, n_passages: int, threshold: float, cells: int = 1 << 22) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All (passage, entry, score) with score >= threshold, of distinct (passage, term) pairs sorted by passage."""
        ub = self.top[term]
        live = np.bincount(passage, ub, n_passages) >= threshold - 1e-9
        keep = live[passage]
        passage, term, ub = passage[keep], term[keep], ub[keep]
        out = ([], [], [])
        step = max(1, cells // max(1, self.n_entries))
        numbers = np.flatnonzero(live)
        if not len(numbers):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        cut = np.searchsorted(passage, numbers[::step])
        for a, b in zip(cut, [*cut[1:], len(passage)], strict=True):
            for x, y in zip(out, self._some(passage[a:b], term[a:b], ub[a:b], threshold), strict=True):
                x.append(y)
        return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)

    def _some(self, passage, term, ub, threshold):
        names, p = np.unique(passage, return_inverse=True)
        order = np.lexsort((ub, p))
        p, t, ub = p[order], term[order], ub[order]
        total = np.cumsum(ub)
        first = np.flatnonzero(np.diff(p, prepend=-1))
        below = total - np.repeat(total[first] - ub[first], np.diff(first, append=len(p)))
        pivot = below >= threshold - 1e-9
        rest = np.bincount(p[~pivot], ub[~pivot], len(names))
        size = self.block_at[t[pivot] + 1] - self.block_at[t[pivot]]
        post = _spread(self.block_at[t[pivot]], size)
        bound = np.bincount(np.repeat(p[pivot], size) * self.n_blocks + self.block[post], self.block_top[post], len(names) * self.n_blocks).reshape(len(names), -1)
        alive = (bound > 0) & (bound + rest[:, None] >= threshold - 1e-9)
        some = alive.any(axis=1)[p]
        p, t = p[some], t[some]
        if not len(p):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        size = self.at[t + 1] - self.at[t]
        post = _spread(self.at[t], size)
        entry, who = self.entry[post], np.repeat(p, size)
        near = alive[who, entry // BLOCK]
        score = np.bincount(who[near] * self.n_entries + entry[near], self.impact[post][near], len(names) * self.n_entries)
        hit = np.flatnonzero(score >= threshold - 1e-9)
        return names[hit // self.n_entries], hit % self.n_entries, score[hit]

    def hits(self, texts: list[str], threshold: float) -> list[tuple[int, int, float, float, float]]:
        """(text number, item id, score, question overlap, answer overlap) of verified hits."""
        if not self.n_entries:
            return []
        get = self.terms.get
        split, lists, base, total = [], [], [], 0
        for text in texts:
            w = words_of(text)
            split.append(w)
            lists.append(np.array([get(x, -1) for x in w], np.int64))
            base.append(total)
            total += max(1, -(-len(w) // STRIDE))
        keys = []
        for ids, first in zip(lists, base, strict=True):
            known = np.flatnonzero(ids >= 0)
            at, t = first + known // STRIDE, ids[known]
            keys.append(at * len(self.terms) + t)
            before = known >= STRIDE
            keys.append((at[before] - 1) * len(self.terms) + t[before])
        key = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
        passage, entry, score = self.search(key // len(self.terms), key % len(self.terms), total, threshold)
        text_of = np.searchsorted(base, passage, "right") - 1
        best: dict[tuple[int, int], tuple] = {}
        for p, e, s, d in zip(passage.tolist(), entry.tolist(), score.tolist(), text_of.tolist(), strict=True):
            i = int(self.item_of[e])
            _, question, answer, n = self.items[i]
            at = (p - base[d]) * STRIDE
            region = split[d][max(0, at - n) : at + WINDOW + n]
            k = max(1, min(3, len(question)))
            q = _shares([tuple(question[j : j + k]) for j in range(len(question) - k + 1)] if question else [], {tuple(region[j : j + k]) for j in range(len(region) - k + 1)})
            a = _shares(answer, set(region))
            if q >= 0.5 and a >= 0.5:
                found = (d, self.items[i][0], s, q, a)
                if (d, i) not in best or found[2:] > best[d, i][2:]:
                    best[d, i] = found
        return list(best.values())


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, segments that hold it); the row without a term has the number of segments and of words."""
    for batch in slices(batches, 64):
        seen, n, words = Counter(), 0, 0
        for text in strings(batch.column(0)):
            parts = segments(words_of(text))
            seen.update(t for w in parts for t in set(w))
            n, words = n + len(parts), words + sum(map(len, parts))
        yield pa.RecordBatch.from_arrays([pa.array([None, *seen], pa.string()), pa.array([n, *seen.values()], pa.int64()), pa.array([words] + [0] * len(seen), pa.int64())], names=["term", "n", "words"])


def pieces(benchmark: DataFrame, piece_bytes: int = 16 << 20) -> Iterator[Index]:
    """Indexes of the items, each of at most ``piece_bytes`` of text."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where(F.length("text") > 0)
    counted = None
    if (items.agg(F.sum(F.octet_length("text"))).head()[0] or 0) > piece_bytes:
        tally = items.select("text").mapInArrow(_tally, "term string, n long, words long")
        counted = materialize(tally.groupBy("term").agg(F.sum("n").alias("n"), F.sum("words").alias("words")), "bm25-terms")
        whole = counted.where("term is null").head()

    def index(held: list[tuple[int, str]]) -> Index:
        if counted is None:
            return Index(held)
        own = spark.createDataFrame([(t,) for t in {t for _, text in held for t in words_of(text)}], "term string")
        known = Statistics({r["term"]: r["n"] for r in counted.join(own, "term").collect()}, whole["n"], whole["words"] / max(1, whole["n"]))  # the words of one piece
        return Index(held, known)

    size, held = 0, []
    for row in items.orderBy("item_id", "text").toLocalIterator():  # in bounded parts; never the whole table at once
        n = len(row["text"].encode())
        if held and size + n > piece_bytes:
            yield index(held)
            size, held = 0, []
        held.append((row["item_id"], row["text"]))
        size += n
    if held:
        yield index(held)
    discard(counted)


def _finder(index, threshold: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            ids = batch.column(0).to_pylist()
            found = index.value.hits(strings(batch.column(1)), threshold)
            yield pa.RecordBatch.from_arrays([pa.array([ids[x[0]] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64()), *(pa.array([x[k] for x in found], pa.float64()) for k in (2, 3, 4))], names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

    return run


def find_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5, piece_bytes: int = 16 << 20) -> DataFrame:
    """Verified hits: ``doc_id, item_id, score, question_overlap, answer_overlap``, best passage of each pair."""
    spark = docs.sparkSession
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for index in pieces(benchmark, piece_bytes):
        part = named.mapInArrow(_finder(spark.sparkContext.broadcast(index), threshold), HITS)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], HITS) if out is None else out


def keep_unleaked(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5, piece_bytes: int = 16 << 20) -> DataFrame:
    """The rows, with all their columns, in which no item is found."""
    at, spark = docs.columns.index("text"), docs.sparkSession

    def keeper(index) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, 64):
                bad = {x[0] for x in index.value.hits(strings(batch.column(at)), threshold)}
                yield batch.filter(pa.array([i not in bad for i in range(batch.num_rows)], pa.bool_()))

        return run

    out = docs
    for index in pieces(benchmark, piece_bytes):
        out = out.mapInArrow(keeper(spark.sparkContext.broadcast(index)), docs.schema)
    return out
