"""Toxicity by multiple-instance learning with noisy-or.

A document is a bag of sentences. A sentence's score is a logistic function of
the weights of its words; a document's score is the noisy-or of its sentences,
``1 - prod(1 - p)``. Only document labels are known: the weights maximise the
likelihood of those labels, so blame settles on the sentences that explain them,
and the same weights then locate offending sentences.

The features of a word are the word itself and its beginnings of 3 to 9 letters,
so that inflected forms of one stem share what is learned. Training reads at
most ``max_train`` labelled documents (a documented bound, in the order of a hash
of the id); their ids, never the texts, are broadcast. Of that sample's features
the ``max_words`` with the greatest chi-square that ``min_docs`` documents hold
are learned, and weights up to ``min_weight`` are left out of the model: bounds
of the model, not of what it reads. Scoring reads every document, whole, of any
length.

Defined results: null and empty texts, and texts without a word, score 0; a
label row without id or label is not used; several labels of one id count as the
highest; without both labels in the sample every text with a word scores the
share of label 1; rows that repeat are scored each; an empty table gives an
empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialize, slices, strings

#: Words, or the signs that end a sentence.
TOKEN = re.compile(r"\w+|[.!?\n]+")
ENDS = ".!?\n"


def features(word: str) -> list[str]:
    return [word, *(word[:k] + "*" for k in range(3, min(len(word), 10)))]


class _Lookup(dict):
    """What ``make`` gives for a token, kept; starts anew when full."""

    def __init__(self, make: Callable, limit: int = 200_000):
        self.make, self.limit = make, limit

    def __missing__(self, token: str):
        if len(self) >= self.limit:
            self.clear()
        value = self[token] = self.make(token)
        return value


@dataclass
class NoisyOr:
    """Word weights and the bias of a sentence score."""

    words: list[str] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = 0.0
    constant: float | None = None

    def __post_init__(self):
        weight = dict(zip(self.words, self.weights.tolist(), strict=True))
        #: a word's summed weights; not a number for the end of a sentence
        self.weight_of = _Lookup(lambda t: float("nan") if t[0] in ENDS else sum(weight.get(f, 0.0) for f in features(t)))

    def __getstate__(self):
        return {"words": self.words, "weights": self.weights, "bias": self.bias, "constant": self.constant}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.__post_init__()

    def sentences(self, text: str) -> np.ndarray:
        """The score of each sentence that has a word, in order."""
        x = np.array(list(map(self.weight_of.__getitem__, TOKEN.findall(text.lower()))), float)
        word = ~np.isnan(x)
        sid = np.cumsum(~word)[word]
        first = np.flatnonzero(np.diff(sid, prepend=-1))
        if self.constant is not None:
            return np.full(len(first), self.constant)
        return 1 / (1 + np.exp(-self.bias - (np.add.reduceat(x[word], first) if len(first) else first)))

    def score(self, text: str) -> tuple[float, int, int]:
        """Document score, number of sentences, number of sentences scored 0.5 or more."""
        p = self.sentences(text)
        if self.constant is not None:
            return (self.constant if len(p) else 0.0), len(p), 0
        return float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum())), len(p), int((p >= 0.5).sum())


def held_out(id_col: str = "doc_id"):
    """Rows never used for learning: crc32 of the id as text leaves 2 on division by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _train_docs(docs: DataFrame, labels: DataFrame, max_train: int) -> DataFrame:
    named = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("y"))
    known = named.where(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("y").alias("y"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(F.length("text") > 0)
    # bounded by max_train ids
    joined = texts.join(F.broadcast(chosen), "doc_id").select("y", "text", F.xxhash64("text").alias("h"))
    # copies of a text count once
    return joined.groupBy("h").agg(F.max("y").alias("y"), F.first("text").alias("text"))


def _vocabulary(train: DataFrame, max_words: int, min_docs: int) -> list[str]:
    """Words by the chi-square of their documents' labels."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by: tuple[Counter, Counter] = (Counter(), Counter())
        n = [0, 0]
        for batch in batches:
            for y, text in zip(batch.column(0).to_pylist(), strings(batch.column(1)), strict=True):
                by[y > 0].update({f for w in set(re.findall(r"\w+", text.lower())) for f in features(w)})
                n[y > 0] += 1
        words = ["", *(by[0].keys() | by[1].keys())]  # the empty word counts documents
        by[0][""], by[1][""] = n
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([by[0][w] for w in words], pa.int64()), pa.array([by[1][w] for w in words], pa.int64())], names=["w", "neg", "pos"])

    counts = train.select("y", "text").mapInArrow(tally, "w string, neg long, pos long").groupBy("w").agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos"))
    counts = materialize(counts, "tox-words")
    total = counts.where("w = ''").head(1)
    if not total or not total[0]["neg"] or not total[0]["pos"]:
        discard(counts)
        return []
    n0, n1 = float(total[0]["neg"]), float(total[0]["pos"])
    df = F.col("neg") + F.col("pos")
    gap = F.col("pos") * F.lit(n0) - F.col("neg") * F.lit(n1)
    chi = gap * gap / (df * (F.lit(n0 + n1) - df + 1))
    rows = counts.where((F.col("w") != "") & (df >= min_docs)).orderBy(chi.desc(), "w").limit(max_words).select("w").collect()
    discard(counts)
    return [r["w"] for r in rows]


def _bags(train: DataFrame, words: list[str]) -> list:
    """Of each document: label, sentences without a chosen feature, (sentence, feature) pairs of the others."""
    code = {w: i for i, w in enumerate(words)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes_of = _Lookup(lambda t: [code[f] for f in features(t) if f in code])
        for batch in slices(batches):
            plain, sids, wids = [], [], []
            for text in strings(batch.column(1)):
                bare, sid, wid, n = 0, [], [], 0
                for sentence in re.split(r"[.!?\n]+", text.lower()):
                    tokens = re.findall(r"\w+", sentence)
                    found = [c for t in tokens for c in codes_of[t]]
                    if found:
                        sid += [n] * len(found)
                        wid += found
                        n += 1
                    elif tokens:
                        bare += 1
                plain.append(bare)
                sids.append(sid)
                wids.append(wid)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(plain, pa.int64()), pa.array(sids, pa.list_(pa.int32())), pa.array(wids, pa.list_(pa.int32()))], names=["y", "plain", "sid", "wid"])

    return train.select("y", "text").mapInArrow(run, "y int, plain long, sid array<int>, wid array<int>").collect()


def fit(docs: DataFrame, labels: DataFrame, max_train: int = 8_000, max_words: int = 3_000, min_docs: int = 5, rounds: int = 300, rate: float = 0.15, l2: float = 5e-5, min_weight: float = 0.05) -> NoisyOr:
    """Learn from document labels. The driver gets ``max_train`` small bags of word codes."""
    train = materialize(_train_docs(docs, labels, max_train), "tox-train")
    words = _vocabulary(train, max_words, min_docs)
    if not words:
        share = train.agg(F.avg((F.col("y") > 0).cast("double"))).head()[0]
        discard(train)
        return NoisyOr(constant=float(share or 0.0))
    bags = _bags(train, words)
    discard(train)
    y = np.array([float(b["y"] > 0) for b in bags])
    plain = np.array([b["plain"] for b in bags], float)
    doc, sent, word, n = [], [], [], 0
    for d, b in enumerate(bags):
        if b["sid"]:
            s = np.array(b["sid"])
            k = s.max() + 1
            doc.append(np.full(k, d))
            sent.append(s + n)
            word.append(np.array(b["wid"]))
            n += k
    doc, sent, word = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (doc, sent, word))
    w, b = np.zeros(len(words)), -5.0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, rounds + 1):
        z = np.bincount(sent, w[word], n) + b
        p = 1 / (1 + np.exp(-z))
        base = 1 / (1 + np.exp(-b))
        log_clean = np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-9)), len(y)) + plain * np.log1p(-base)
        clean = np.exp(log_clean)
        # d(-log likelihood)/dz of a sentence: p for label 0, -p * clean / (1 - clean) for label 1
        pull = np.where(y > 0, -clean / np.maximum(1 - clean, 1e-9), 1.0) / len(y)
        g = pull[doc] * p
        grad = np.append(np.bincount(word, g[sent], len(w)) + l2 * w, g.sum() + (pull * plain).sum() * base)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    keep = np.abs(w) > min_weight
    return NoisyOr([x for x, k in zip(words, keep, strict=True) if k], w[keep], float(b))


def _scorer(model: NoisyOr, at: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [model.score(t) for t in strings(batch.column(at))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([x[i] for x in found], kind) for i, kind in enumerate((pa.float64(), pa.int32(), pa.int32())))], names=["doc_id", "score", "n_sentences", "n_offending"])

    return run


def score_documents(docs: DataFrame, model: NoisyOr) -> DataFrame:
    """Per document: ``doc_id, score, n_sentences, n_offending``."""
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return named.mapInArrow(_scorer(model, 1), "doc_id long, score double, n_sentences int, n_offending int")


def keep_clean(docs: DataFrame, model: NoisyOr, threshold: float = 0.3) -> DataFrame:
    """The rows, with all their columns, that score below ``threshold``."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array([model.score(t)[0] < threshold for t in strings(batch.column(at))], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def locate(docs: DataFrame, model: NoisyOr, threshold: float = 0.3) -> DataFrame:
    """Offending sentences: ``doc_id, sentence, start, end, score, text``; offsets in characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("sentence", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("text", pa.string())])
        for batch in slices(batches, 64):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), strings(batch.column(1)), strict=True):
                p = model.sentences(text)
                if not (p >= threshold).any():
                    continue
                spans = [s for s in (m.span() for m in re.finditer(r"[^.!?\n]+", text)) if re.search(r"\w", text[s[0] : s[1]])]
                rows += [{"doc_id": doc_id, "sentence": i, "start": a, "end": b, "score": float(p[i]), "text": text[a:b].strip()} for i, (a, b) in enumerate(spans) if p[i] >= threshold]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return named.mapInArrow(run, "doc_id long, sentence int, start long, end long, score double, text string")


def worst_first(located: DataFrame) -> DataFrame:
    """Located sentences ranked within their document."""
    order = Window.partitionBy("doc_id").orderBy(F.desc("score"), "sentence")
    return located.withColumn("rank", F.row_number().over(order))
