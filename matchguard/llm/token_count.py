"""Token counts by a map-side two-tier lookup.

A pre-token is a stretch of text that begins at a space after a non-space. No
piece of the model holds a space after another character, so merges stay inside
a pre-token and a text's count is the sum over its pre-tokens. Tier one is a
broadcast table of the lengths of pre-tokens that a sample of documents finds
frequent (at most ``frequent`` entries); tier two is each worker's own cache,
filled by the library in batches and emptied at ``limit``. No pre-token is ever
shuffled; the sample only warms tier one and never changes a count.

Defined results: null and empty texts have 0 tokens and 0 bytes; ids, nulls
among them, pass through; texts of any length are counted whole; texts with runs
of spaces or the model's own sign for a space go to the library as they are; rows
that repeat are counted each; an empty table
gives an empty result; other columns are dropped.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, strings


class PieceCounter:
    """Lengths of texts in pieces of a sentencepiece model."""

    def __init__(self, path: str, frequent: dict[str, int] | None = None, limit: int = 400_000):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        self.begins = np.array([p.startswith("▁") for p in pieces])
        #: True if pre-tokens can be counted one by one
        self.parts = not any("▁" in p.lstrip("▁") for p in pieces) and self._plain()
        self.frequent, self.limit = dict(frequent or {}), limit
        self.cache = dict(self.frequent)

    def _plain(self) -> bool:
        """The model adds one space in front and keeps all others."""
        return self.model.encode("a  b", out_type=str)[:1] == ["▁a"] and len(self.model.encode("a  b")) > len(self.model.encode("a b"))

    def lengths(self, words: list[str]) -> list[int]:
        return [len(x) for x in self.model.encode(words, num_threads=1)]

    def _learn(self, words: list[str]) -> list[int]:
        """Lengths of pre-tokens without spaces: counted in long lines, cut at the pieces that begin a word."""
        out: list[int] = []
        lines = [words[a : a + 512] for a in range(0, len(words), 512)]
        for line, ids in zip(lines, self.model.encode([" ".join(x) for x in lines], num_threads=1), strict=True):
            starts = np.flatnonzero(self.begins[ids]) if all(line) else ()
            out += np.diff(starts, append=len(ids)).tolist() if len(starts) == len(line) else self.lengths(line)
        return out

    def count(self, texts: list[str]) -> list[int]:
        out = [0] * len(texts)
        if self.parts:
            plain = [i for i, t in enumerate(texts) if t and "  " not in t and t[0] != " " and t[-1] != " " and "▁" not in t]
        else:
            plain = []
        split = [texts[i].split(" ") for i in plain]
        if len(self.cache) > len(self.frequent) + self.limit:
            self.cache = dict(self.frequent)
        cache = self.cache
        new = [w for w in set().union(*split) if w not in cache] if split else []
        if new:
            cache.update(zip(new, self._learn(new), strict=True))
        get = cache.__getitem__
        for i, words in zip(plain, split, strict=True):
            out[i] = sum(map(get, words))
        rest = sorted(set(range(len(texts))).difference(plain))  # runs of spaces, or the sign that stands for one: the library counts the whole text
        for i, n in zip(rest, self.lengths([texts[i] for i in rest]) if rest else [], strict=True):
            out[i] = n
        return out


_COUNTERS: dict[tuple[str, int], PieceCounter] = {}


def _counter(path: str, table) -> PieceCounter:
    key = (path, table.id)
    if key not in _COUNTERS:
        _COUNTERS.clear()
        words, lengths = table.value
        _COUNTERS[key] = PieceCounter(path, dict(zip(words.split(" "), lengths.tolist(), strict=True)) if len(lengths) else None)
    return _COUNTERS[key]


class _Table:
    """A broadcast with the number that names it in the workers' caches."""

    def __init__(self, broadcast, number: int):
        self.broadcast, self.id = broadcast, number

    @property
    def value(self):
        return self.broadcast.value


def frequent_lengths(texts: DataFrame, path: str, frequent: int = 65_536, sample_docs: int = 2_000, seed: int = 7) -> tuple[str, np.ndarray]:
    """The compact table: frequent pre-tokens joined by spaces, and their lengths.

    Counts come from a random sample of about ``sample_docs`` documents, so what
    reaches the driver is bounded: each task sends pre-tokens that it saw twice.
    """
    n = texts.count()
    if not n:
        return "", np.zeros(0, np.uint16)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for text in strings(batch.column(0)):
                seen.update(text.split(" "))
        top = [(w, c) for w, c in seen.most_common(frequent) if c > 1 and w]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in top], pa.string()), pa.array([c for _, c in top], pa.int64())], names=["w", "c"])

    sample = texts.sample(fraction=min(1.0, sample_docs / n), seed=seed)
    total: Counter[str] = Counter()
    for row in sample.mapInArrow(tally, "w string, c long").toLocalIterator():
        total[row["w"]] += row["c"]
        if len(total) > 8 * frequent:
            total = Counter(dict(total.most_common(4 * frequent)))
    words = [w for w, _ in total.most_common(frequent)]
    lengths = PieceCounter(path).lengths(words) if words else []
    return " ".join(words), np.array(lengths, np.uint32)


def _mapper(path: str, table: _Table) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path, table)
        for batch in slices(batches):
            texts = strings(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(counter.count(texts), pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    return run


_NUMBER = iter(range(1 << 62))


def count_tokens(docs: DataFrame, path: str, max_tokens: int = 4096, frequent: int = 65_536, sample_docs: int = 2_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``doc_id, n_bytes, n_tokens, over_limit`` (n_tokens > max_tokens)."""
    spark = docs.sparkSession
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    value = frequent_lengths(named.select("text"), path, frequent, sample_docs)
    table = _Table(spark.sparkContext.broadcast(value), next(_NUMBER))
    rows = named.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    counted = rows.mapInArrow(_mapper(path, table), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(max_tokens))
