"""LM scoring by masked pseudo-likelihood.

Every token of a document is predicted from the ``SIDE`` tokens on either side
by one small network; a document's score is the sum of the conditional log
probabilities.

* tokens: words (as the n-gram join cuts them), hashed to ``VOCABULARY`` ids;
* counts of all ids come from all documents (a shuffle of partial sums);
* network: a row for each context id and place, summed and put through tanh,
  then a softmax over ``CLASSES`` token classes, then one over ``GROUPS`` groups
  of the class, which starts at the groups' counts. Frequent tokens are a class
  (or a group) of their own, the others are dealt to classes (and groups) of
  about equal mass. A token has its share of counts of its group: only tokens of
  one group, all of them rare, are told apart by counts alone;
* training: numpy in tasks, each round on another part of all documents, every
  token once in all; the tasks' weights are averaged by tokens seen in two
  grouped steps, so no task and not the driver sees more than a bounded share.

What is gathered (counts, weights) grows with the number of tasks; what is
broadcast (a count for each id in use, one network) has a bound. Words that hash to one
id are one token: 404,216 words leave about one in six with company.

Defined results: null, empty and blank texts have 0 tokens, score 0 and a null
mean; ids, nulls among them, pass through; rows that repeat are scored each; an
empty table gives an empty result; a text of any length is scored whole, its ids
in one task's memory; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices
from .ngram_join import word_hashes

VOCABULARY, CONTEXTS, CLASSES, GROUPS, HIDDEN, SIDE = 1 << 21, 1 << 12, 64, 64, 32, 2
OFFSETS = [o for o in range(-SIDE, SIDE + 1) if o]
PAD = CONTEXTS  # the row of places before and after a document


def token_ids(text: str | None) -> np.ndarray:
    return (word_hashes((text or "").encode()) >> np.uint64(40)).astype(np.int64) % VOCABULARY


def _dealt(mass: np.ndarray, parts: int) -> np.ndarray:
    """Parts of ids in falling order of mass: half of the parts for one id each, the others of about equal mass."""
    if len(mass) <= parts:
        return np.arange(len(mass))
    own = parts // 2
    upto = np.cumsum(mass[own:])
    rest = own + np.minimum((upto - mass[own:]) * (parts - own) / upto[-1], parts - own - 1).astype(np.int64)
    return np.concatenate([np.arange(own), rest])


@dataclass
class Tables:
    """What the counts fix: a token's class and group, its share of the class, its context row, and the groups' shares.

    Only the counts that are not 0 are sent; a worker builds the arrays again.
    """

    seen: tuple[np.ndarray, np.ndarray]

    klass: np.ndarray
    group: np.ndarray
    log_share: np.ndarray
    context: np.ndarray
    bias: np.ndarray

    @classmethod
    def from_counts(cls, counts: np.ndarray) -> Tables:
        mass = counts + max(1, (counts == 1).sum()) / VOCABULARY  # unseen ids keep a share
        used = np.flatnonzero(counts)
        order = np.concatenate([used[np.argsort(-counts[used], kind="stable")], np.flatnonzero(counts == 0)])
        klass, group = np.empty(VOCABULARY, np.uint8), np.empty(VOCABULARY, np.uint8)
        line = _dealt(mass[order], CLASSES)
        klass[order] = line
        for c in range(CLASSES):
            own = order[slice(*np.searchsorted(line, [c, c + 1]))]
            group[own] = _dealt(mass[own], GROUPS)
        total = np.bincount(klass, mass, CLASSES)
        bias = np.full(CLASSES * GROUPS, -1e9)
        held = np.bincount(klass.astype(np.int64) * GROUPS + group, mass, CLASSES * GROUPS).reshape(CLASSES, GROUPS)
        np.log(held / np.maximum(total, 1e-300)[:, None], out=bias.reshape(CLASSES, GROUPS), where=held > 0)
        single = CONTEXTS * 7 // 8
        context = np.empty(VOCABULARY, np.int16)
        context[order[:single]] = np.arange(single)
        context[order[single:]] = single + order[single:] % (CONTEXTS - single)
        return cls((used.astype(np.int32), counts[used]), klass, group, np.log(mass / total[klass]).astype(np.float32), context, bias.reshape(CLASSES, GROUPS).astype(np.float32))

    def __reduce__(self) -> tuple:
        return _rebuilt, self.seen

    def by_class(self, tokens: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
        """The order that puts tokens of a class together, and (class, start, end) there for classes of several groups."""
        klass = self.klass[tokens]
        order = np.argsort(klass, kind="stable")
        ends = np.searchsorted(klass[order], np.arange(CLASSES + 1)).tolist()
        return order, [(c, a, b) for c, a, b in zip(range(CLASSES), ends[:-1], ends[1:], strict=True) if a < b and self.bias[c, 1] > -1e8]


_BUILT: dict[int, Tables] = {}


def _rebuilt(used: np.ndarray, n: np.ndarray) -> Tables:
    """The tables of these counts; a process keeps those that it built last."""
    key = hash((used.tobytes(), n.tobytes()))
    if key not in _BUILT:
        _BUILT.clear()
        counts = np.zeros(VOCABULARY, n.dtype)
        counts[used] = n
        _BUILT[key] = Tables.from_counts(counts)
    return _BUILT[key]


def normal(z: np.ndarray) -> np.ndarray:
    """Rows of log odds to log probabilities; odds beyond e^60, which exp would not hold, are cut there."""
    np.minimum(z, 60, out=z)
    z -= np.log(_total(np.exp(z)))[:, None]
    return z


def _total(z: np.ndarray) -> np.ndarray:
    return z @ np.ones(z.shape[1], z.dtype)


def shares(z: np.ndarray) -> np.ndarray:
    """Rows of log odds to probabilities, cut like :func:`normal`."""
    np.exp(np.minimum(z, 60, out=z), out=z)
    z /= _total(z)[:, None]
    return z


def picked(z: np.ndarray, column: np.ndarray) -> np.ndarray:
    """The log probability of one column of each row of log odds, cut like :func:`normal`."""
    np.minimum(z, 60, out=z)
    return z[np.arange(len(z)), column] - np.log(_total(np.exp(z)))


class Network:
    """Context rows for each place, hidden bias, class weights and bias, weights of the groups in each class."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.rows = rng.normal(0, 0.1, (len(OFFSETS), CONTEXTS + 1, HIDDEN)).astype(np.float32)
        self.bias = np.zeros(HIDDEN, np.float32)
        self.out = rng.normal(0, 0.1, (HIDDEN, CLASSES)).astype(np.float32)
        self.out_bias = np.zeros(CLASSES, np.float32)
        self.nodes = np.zeros((CLASSES, HIDDEN, GROUPS), np.float32)

    def flat(self) -> np.ndarray:
        return np.concatenate([self.rows.ravel(), self.bias, self.out.ravel(), self.out_bias, self.nodes.ravel()])

    @classmethod
    def of(cls, flat: np.ndarray) -> Network:
        net, at = cls.__new__(cls), 0
        for name, shape in (("rows", (len(OFFSETS), CONTEXTS + 1, HIDDEN)), ("bias", (HIDDEN,)), ("out", (HIDDEN, CLASSES)), ("out_bias", (CLASSES,)), ("nodes", (CLASSES, HIDDEN, GROUPS))):
            n = int(np.prod(shape))
            setattr(net, name, flat[at : at + n].reshape(shape).astype(np.float32))
            at += n
        return net

    def hidden(self, context: np.ndarray) -> np.ndarray:
        """Hidden values for rows of context ids."""
        h = np.take(self.rows[0], context[:, 0], axis=0)
        for o in range(1, len(OFFSETS)):
            h += np.take(self.rows[o], context[:, o], axis=0)
        h += self.bias
        return np.tanh(h, out=h)

    def classes(self, h: np.ndarray) -> np.ndarray:
        """Log odds of the classes."""
        z = h @ self.out
        z += self.out_bias
        return z

    def forward(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hidden values and class log probabilities for rows of context ids."""
        h = self.hidden(context)
        return h, normal(self.classes(h))

    def groups(self, h: np.ndarray, c: int, tables: Tables) -> np.ndarray:
        """Log odds of a class's groups."""
        z = h @ self.nodes[c]
        z += tables.bias[c]
        return z

    def within(self, h: np.ndarray, tokens: np.ndarray, tables: Tables) -> np.ndarray:
        """What the neighbours add to the log of each token's share of its class."""
        order, runs = tables.by_class(tokens)
        h, group, more = np.take(h, order, axis=0), tables.group[tokens[order]], np.zeros(len(tokens))
        for c, a, b in runs:
            g = group[a:b]
            more[order[a:b]] = picked(self.groups(h[a:b], c, tables), g) - tables.bias[c, g]
        return more


def windows(ids: list[np.ndarray], tables: Tables) -> tuple[np.ndarray, np.ndarray]:
    """All tokens of some documents, and the context ids around each; documents do not see each other."""
    gap = np.full(SIDE, -1)
    line = np.concatenate([gap, *(x for d in ids for x in (d, gap))])
    at = np.flatnonzero(line >= 0)
    context = np.where(line >= 0, tables.context[line], PAD)
    return line[at], np.stack([context[at + o] for o in OFFSETS], axis=1)


class Trainer:
    """Stochastic steps with a rate that falls for each row as its gradients add up."""

    def __init__(self, net: Network, rate: float = 0.15):
        self.net, self.rate = net, rate
        self.seen = [np.full((CONTEXTS + 1, 1), 1e-6, np.float32) for _ in OFFSETS]
        self.seen_nodes = np.full_like(net.nodes, 1e-7)
        self.dense = [np.full_like(x, 1e-6) for x in (net.bias, net.out, net.out_bias)]

    def _move(self, x: np.ndarray, seen: np.ndarray, g: np.ndarray) -> None:
        seen += g * g
        by = np.sqrt(seen)
        np.divide(g, by, out=by)
        by *= self.rate
        x -= by

    def step(self, context: np.ndarray, tokens: np.ndarray, tables: Tables) -> None:
        net, n = self.net, len(tokens)
        order, runs = tables.by_class(tokens)
        context, tokens = context[order], tokens[order]
        h, group = net.hidden(context), tables.group[tokens]
        d = shares(net.classes(h))
        d[np.arange(n), tables.klass[tokens]] -= 1
        d /= n
        back = d @ net.out.T
        grads = np.zeros((CLASSES, HIDDEN, GROUPS), np.float32)
        for c, a, b in runs:
            e = shares(net.groups(h[a:b], c, tables))
            e[np.arange(b - a), group[a:b]] -= 1
            e /= n
            back[a:b] += e @ net.nodes[c].T
            np.matmul(h[a:b].T, e, out=grads[c])
        low = runs[0][0] if runs else CLASSES  # classes before it have no gradient
        self._move(net.nodes[low:], self.seen_nodes[low:], grads[low:])
        back *= 1 - h * h
        one = np.ones(n, np.float32)
        for x, acc, g in zip((net.bias, net.out, net.out_bias), self.dense, (one @ back, h.T @ d, one @ d), strict=True):
            self._move(x, acc, g)
        for o in range(len(OFFSETS)):
            ids = context[:, o].astype(np.uint16)
            order = np.argsort(ids, kind="stable")
            ids = ids[order]
            first = np.flatnonzero(np.diff(ids.astype(np.int32), prepend=-1))
            # two values at a time: sums of complex numbers are those of their parts
            ids, g = ids[first], np.add.reduceat(np.take(back, order, axis=0).view(np.complex64), first).view(np.float32)
            seen = self.seen[o][ids] + np.einsum("ij,ij->i", g, g)[:, None] / HIDDEN
            self.seen[o][ids] = seen
            net.rows[o][ids] -= g * (self.rate / np.sqrt(seen))


def _named(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def count_ids(docs: DataFrame) -> np.ndarray:
    """How often each id occurs in all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(VOCABULARY, np.int64)
        held, n = [], 0
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                held.append(token_ids(text))
                n += len(held[-1])
                if n > VOCABULARY:  # a count of all ids is worth its pass
                    total += np.bincount(np.concatenate(held), minlength=VOCABULARY)
                    held, n = [], 0
        total += np.bincount(np.concatenate([np.zeros(0, np.int64), *held]), minlength=VOCABULARY)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], names=["id", "n"])

    rows = _named(docs).select("text").mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(VOCABULARY)
    counts[rows["id"].to_numpy()] = rows["n"].to_numpy()
    return counts


BLOCKS = 64


def _mean(keys: list[str]) -> Callable:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        weight = pdf["n"].sum()
        total = sum(np.frombuffer(v, np.float32) * np.float32(n / weight) for v, n in zip(pdf["v"], pdf["n"], strict=True))
        return pd.DataFrame([{**{k: pdf[k].iloc[0] for k in keys}, "n": weight, "v": total.tobytes()}])

    return run


def train_round(docs: DataFrame, net: Network, tables: Tables, batch_tokens: int = 4096) -> Network:
    """One pass over ``docs``, in parallel from the same weights, then the mean of the tasks' weights."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((net.flat(), tables))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, known = shared.value
        trainer, n = Trainer(Network.of(flat.copy())), 0
        for batch in slices(batches, 128):
            tokens, context = windows([token_ids(t) for t in batch.column(0).to_pylist()], known)
            order = np.random.default_rng(n).permutation(len(tokens))
            for a in range(0, len(order), batch_tokens):
                part = order[a : a + batch_tokens]
                trainer.step(context[part], tokens[part], known)
            n += len(tokens)
        if n:
            task = TaskContext.get().partitionId()
            for k, v in enumerate(np.array_split(trainer.net.flat(), BLOCKS)):
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([task % 64], pa.int32()), pa.array([n], pa.int64()), pa.array([v.tobytes()], pa.binary())], names=["k", "slot", "n", "v"])

    sent = docs.select("text").mapInArrow(run, "k int, slot int, n long, v binary")
    some = sent.groupBy("k", "slot").applyInPandas(_mean(["k", "slot"]), "k int, slot int, n long, v binary")
    rows = some.groupBy("k").applyInPandas(_mean(["k"]), "k int, n long, v binary").collect()
    if not rows:
        return net
    return Network.of(np.concatenate([np.frombuffer(r["v"], np.float32) for r in sorted(rows, key=lambda r: r["k"])]))


def fit(docs: DataFrame, rounds: int = 2) -> tuple[Network, Tables]:
    """Counts and network from all documents; each document trains in one of the rounds."""
    named = _named(docs)
    tables, net = Tables.from_counts(count_ids(docs)), Network()
    for r in range(rounds):
        net = train_round(named.where(F.pmod(F.xxhash64("text", "doc_id"), F.lit(rounds)) == r), net, tables)
    return net, tables


def log_likelihoods(texts: list[str | None], net: Network, tables: Tables, most: int = 1 << 13) -> tuple[np.ndarray, np.ndarray]:
    """Summed log probability and token count of each text; ``most`` tokens at a time."""
    ids = [token_ids(t) for t in texts]
    size = np.array([len(x) for x in ids], np.int64)
    tokens, context = windows(ids, tables)
    logp = np.empty(len(tokens), np.float64)
    for a in range(0, len(tokens), most):
        t = tokens[a : a + most]
        h = net.hidden(context[a : a + most])
        logp[a : a + most] = picked(net.classes(h), tables.klass[t]) + tables.log_share[t] + net.within(h, t, tables)
    return np.bincount(np.repeat(np.arange(len(ids)), size), logp, len(ids)), size


def score_documents(docs: DataFrame, net: Network, tables: Tables) -> DataFrame:
    """Per document: ``doc_id, n_tokens, log_likelihood`` (sum) and ``mean_log_likelihood``."""
    shared = docs.sparkSession.sparkContext.broadcast((net, tables))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = shared.value
        for batch in slices(batches, 128):
            total, size = log_likelihoods(batch.column(1).to_pylist(), model, known)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size), pa.array(total)], names=["doc_id", "n_tokens", "log_likelihood"])

    scored = _named(docs).mapInArrow(run, "doc_id long, n_tokens long, log_likelihood double")
    return scored.withColumn("mean_log_likelihood", F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")))
