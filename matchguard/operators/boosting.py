"""Boosted trees from histograms (M3), scored as one column expression.

Features are cut into bins once, by exact ranks. Rows with equal bins always
score alike, so training keeps one row for each distinct vector of bins with its
counts of rows and of label 1. These are held in chunks: a row of the table has the bins, counts
and log odds of many vectors as bytes, which a task reads as arrays without a step for each vector. Every level of every tree is one job
over them; what comes to the driver is the best split of each open node, or a bounded number of sums.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.folders import scratch
from .ranks import before, dealt

#: Gains below this are rounding.
_LEAST_GAIN = 1e-6
#: Sums (of 24 bytes each) that may come to the driver for a level.
_CELLS = 2_000_000
#: Vectors of bins in a chunk at most, and nodes whose sums a shuffle brings together.
_CHUNK, _NODES = 32_768, 16
_CHUNKS, _TOLD = "b binary, n binary, pos binary, m binary", "score float, label int, weight long"
_TREE = "f:array<int>,at:array<int>,cut:array<double>,left:array<int>,value:array<double>"


@dataclass(frozen=True)
class BoostedTrees:
    """``cols``, the log odds to start from, and trees as arrays with one place a node.

    Node k sends a row left, to ``left[k]``, if its value of column ``f[k]`` is below ``cut[k]`` (its bin at
    most ``at[k]``), else to ``left[k] + 1``; nulls and NaN go right. At a leaf f is -1, and ``value`` adds to the log odds.
    """

    cols: list[str]
    base: float
    depth: int
    trees: list[dict]

    def score(self, x: str) -> Column:
        """Probability of label 1 for an array of values in the order of ``cols``, as SQL text; no Python runs on the rows."""
        total = f"aggregate({_constant(self.trees)}, {float(self.base)!r}D, (acc, t) -> acc + get(t.value, {_leaf('t', x, self.depth)}))"
        return F.expr(f"1.0D / (1.0D + exp(-{total}))")

    def save(self, spark: SparkSession, path: str) -> None:
        """One row a tree, so a model is not bounded by one row's size."""
        rows = spark.createDataFrame([(n, json.dumps(t)) for n, t in enumerate([{"cols": self.cols, "base": self.base, "depth": self.depth}, *self.trees])], "place int, body string")
        rows.write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> BoostedTrees:
        head, *trees = (json.loads(r["body"]) for r in spark.read.parquet(path).orderBy("place").collect())
        return BoostedTrees(head["cols"], head["base"], head["depth"], trees)


def _constant(trees: list[dict]) -> str:
    """The trees as one constant: generated code is the same for each, so it compiles once."""
    return f"from_json('{json.dumps(trees)}', 'array<struct<{_TREE}>>')"


def _leaf(tree: str, x: str, depth: int) -> str:
    """The place that a row reaches by its values (< cut). SQL text, which Spark parses in one call."""
    if not depth:
        return "0"
    side = f"IF(get({x}, get({tree}.f, k)) < get({tree}.cut, k), 0, 1)"
    return f"aggregate(sequence(1, {depth}), 0, (k, _) -> IF(get({tree}.f, k) < 0, k, get({tree}.left, k) + {side}))"


def bin_edges(df: DataFrame, cols: list[str], bins: int = 256) -> list[list[float]]:
    """For each column the least values of all its bins but the first, in rising order (fewer than ``bins`` each).

    A column of at most ``bins`` distinct values has a bin for each; otherwise a value's bin is given by the
    rank of its last row, exactly, so equal values share a bin. Nulls and NaN are left out. All columns are ranked in one pass.
    """
    each = F.explode(F.array(*(F.struct(F.lit(i).alias("f"), F.col(c).cast("double").alias("v")) for i, c in enumerate(cols))))
    values = df.select(each.alias("e")).select("e.f", "e.v").where(F.col("v").isNotNull() & ~F.isnan("v"))
    rows = dealt(values.groupBy("f", "v").agg(F.count("*").alias("n")), ["f", "v"])
    sizes = {r["f"]: (r["n"], r["d"]) for r in rows.groupBy("f").agg(F.sum("n").alias("n"), F.count("*").alias("d")).collect()}  # one row a column
    total, distinct, starts, places = 0, 0, [], []
    for i in range(len(cols)):
        starts.append(total)
        places.append(distinct)
        n, d = sizes.get(i, (0, 0))
        total, distinct = total + n, distinct + d
    of = lambda numbers: F.get(F.array(*(F.lit(int(n)).cast("long") for n in numbers)), F.col("f"))
    run = Window.partitionBy("_part").orderBy("f", "v")
    first = before(rows, {"_n": F.sum("n"), "_d": F.count("*")})
    at = rows.join(F.broadcast(first), "_part").withColumns({"rank": F.col("_n") + F.sum("n").over(run) - of(starts), "place": F.col("_d") + F.row_number().over(run) - of(places)})
    few, size = of([sizes.get(i, (0, 0))[1] for i in range(len(cols))]) <= bins, of([sizes.get(i, (0, 0))[0] for i in range(len(cols))])
    binned = at.withColumn("bin", F.when(few, F.col("place") - 1).otherwise(F.floor((F.col("rank") - 1) * bins / size)))
    edges: list[list[float]] = [[] for _ in cols]
    for r in binned.groupBy("f", "bin").agg(F.min("v").alias("v")).orderBy("f", "v").collect():  # at most bins rows a column
        edges[r["f"]].append(r["v"])
    return [e[1:] for e in edges]


def bin_of(x: Column, edges: list[float]) -> Column:
    """The number of edges not above ``x``, by halving; nulls and NaN come after all edges."""
    held = F.array(*(F.lit(float(e)) for e in edges)) if edges else F.array().cast("array<double>")
    steps = [1 << k for k in reversed(range(len(edges).bit_length()))]
    if not steps:
        return F.lit(0)
    found = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda k, s: k + F.when(F.get(held, k + s - 1) <= x, s).otherwise(0))
    return F.when(x.isNull() | F.isnan(x), len(edges)).otherwise(found)


def _code(bins: int) -> np.dtype:
    """The kind of number that holds a bin, which is ``bins`` - 2 at most."""
    return np.dtype("u1" if bins - 2 < 256 else "<u4")


def _packed(features: int, bins: int):
    """An Arrow function: rows (b, n, pos) as chunks without log odds, with the sums of n and pos."""

    def chunk(held: list) -> pa.RecordBatch:
        b, n, pos = (np.concatenate(c) for c in zip(*held, strict=True))
        cells = [pa.array([np.ascontiguousarray(b.T).astype(_code(bins)).tobytes()], pa.binary()), *(pa.array([c.astype("<f8").tobytes()], pa.binary()) for c in (n, pos))]
        return pa.RecordBatch.from_arrays([*cells, pa.array([int(n.sum())]), pa.array([int(pos.sum())])], names=["b", "n", "pos", "rows", "ones"])

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        for rows in parts:
            for at in range(0, rows.num_rows, _CHUNK):
                part = rows.slice(at, _CHUNK)
                if sum(len(h[1]) for h in held) + part.num_rows > _CHUNK:
                    yield chunk(held)
                    held = []
                held.append((part.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, features), part.column(1).to_numpy(), part.column(2).to_numpy()))
        if held:
            yield chunk(held)

    return work


def _vectors(rows: pa.RecordBatch, features: int, bins: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Bins (a row a column), counts and log odds of each chunk of a batch, or of plain rows (b, n, pos, m); log odds that are not there yet are 0."""
    if pa.types.is_list(rows.schema.field(0).type):
        b = rows.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, features)
        yield np.ascontiguousarray(b.T), *(rows.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
        return
    for b, n, pos, m in zip(*(rows.column(i) for i in range(4)), strict=True):
        n = np.frombuffer(n.as_buffer(), "<f8")
        yield np.frombuffer(b.as_buffer(), _code(bins)).reshape(features, -1), n, np.frombuffer(pos.as_buffer(), "<f8"), np.frombuffer(m.as_buffer(), "<f8") if m.is_valid else np.zeros(len(n))


def _reached(b: np.ndarray, tree: dict, depth: int) -> np.ndarray:
    """The place that each vector reaches by its bins."""
    kind, at_most, left = (np.array(tree[k], dtype=np.int32) for k in ("f", "at", "left"))
    flat, column, size = b.ravel(), np.maximum(kind, 0) * b.shape[1], b.shape[1]
    node, row = np.zeros(size, dtype=np.int32), np.arange(size, dtype=np.int32)
    moving = row
    for _ in range(depth):
        at = node[moving]
        if len(moving):
            inner = kind[at] >= 0
            if not inner.all():
                moving, at = moving[inner], at[inner]
        if not len(moving):
            break
        node[moving] = left[at] + (flat[column[at] + moving] > at_most[at])
    return node


def _sums(tree: dict, depth: int, features: int, bins: int):
    """An Arrow function: a task's vectors (b, n, pos, m) -> its sums of both derivatives by open node, column and bin."""
    kind = np.array(tree["f"])
    opened = np.flatnonzero(kind == -2)
    number = np.zeros(len(kind), dtype=np.int64)
    number[opened] = np.arange(len(opened))

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(opened) * bins
        gs, hs, held = np.zeros((features, size)), np.zeros((features, size)), np.zeros((features, size), dtype=bool)
        for rows in parts:
            for b, n, pos, m in _vectors(rows, features, bins):
                node = _reached(b, tree, depth)
                keep = np.flatnonzero(kind[node] == -2)
                p = 1 / (1 + np.exp(-m[keep]))
                g, h = n[keep] * p - pos[keep], n[keep] * p * (1 - p)
                first = number[node[keep]] * bins
                for i in range(features):
                    key = first + b[i][keep]
                    gs[i] += np.bincount(key, g, size)
                    hs[i] += np.bincount(key, h, size)
                    held[i][key] = True
        f, cell = np.nonzero(held)
        order = np.lexsort((f, cell // bins))  # by node, then by column, then by bin
        f, cell = f[order], cell[order]
        yield pa.RecordBatch.from_arrays([pa.array(opened[cell // bins], pa.int32()), pa.array(f, pa.int32()), pa.array(cell % bins, pa.int32()), pa.array(gs[f, cell]), pa.array(hs[f, cell])], names=["node", "f", "bin", "g", "h"])

    return work


def _blocks(tree: dict, depth: int, features: int, bins: int):
    """An Arrow function: what :func:`_sums` gives, as one row of bytes for each few open nodes."""
    sums, opened = _sums(tree, depth, features, bins), np.flatnonzero(np.array(tree["f"]) == -2)

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for cells in sums(parts):
            node, f, b, g, h = (c.to_numpy() for c in cells.columns)
            cell, block = (node.astype("<i8") * features + f) * bins + b, np.searchsorted(opened, node) // _NODES
            ends = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)] if len(block) else []
            held = [(int(block[i]), task, *(c[i:j].tobytes() for c in (cell, g, h))) for i, j in zip(ends[:-1], ends[1:], strict=True)]
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=["block", "task", "cell", "g", "h"])

    return work


def _moved(tree: dict, depth: int, features: int, bins: int):
    """An Arrow function: chunks with the value of each vector's leaf added to its log odds."""
    value = np.array(tree["value"])

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in parts:
            m = [(m + value[_reached(b, tree, depth)]).astype("<f8").tobytes() for b, _, _, m in _vectors(rows, features, bins)]
            yield pa.RecordBatch.from_arrays([*rows.columns[:3], pa.array(m, pa.binary())], names=["b", "n", "pos", "m"])

    return work


def _told(features: int, bins: int):
    """An Arrow function: chunks -> (score, label, weight) of their vectors."""

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in parts:
            for _, n, pos, m in _vectors(rows, features, bins):
                score = (1 / (1 + np.exp(-m))).astype(np.float32)
                for label, weight in ((1, pos), (0, n - pos)):
                    held = weight > 0
                    yield pa.RecordBatch.from_arrays([pa.array(score[held]), pa.array(np.full(held.sum(), label, np.int32)), pa.array(weight[held].astype(np.int64))], names=["score", "label", "weight"])

    return work


def _folded(rows: list, features: int, bins: int, share: float, least: float) -> list[dict]:
    """The best splits, from tasks' sums of some nodes."""
    cell, g, h = (np.concatenate([np.frombuffer(r[c], kind) for r in rows]) if rows else np.zeros(0, kind) for c, kind in (("cell", "<i8"), ("g", "<f8"), ("h", "<f8")))
    nodes, at = np.unique(cell // (features * bins), return_inverse=True)
    key, size = at * (features * bins) + cell % (features * bins), len(nodes) * features * bins
    fold = lambda w: np.bincount(key, w, size).reshape(len(nodes), features, bins)
    held, gl, hl = fold(None) > 0, fold(g).cumsum(axis=2), fold(h).cumsum(axis=2)
    gt, ht = gl[:, :, -1:], hl[:, :, -1:]
    gain = gl * gl / (hl + share) + (gt - gl) ** 2 / (ht - hl + share) - gt * gt / (ht + share)
    gain = np.where(held & (hl >= least) & (ht - hl >= least) & (gain > _LEAST_GAIN), np.round(gain, 9), -np.inf).reshape(len(nodes), -1)
    out = []
    for k, place in enumerate(gain.argmax(axis=1) if len(nodes) else ()):  # the first of equals: the least column, then the least bin
        i, j = divmod(int(place), bins)
        s = {"f": i, "bin": j, "gl": float(gl[k, i, j]), "hl": float(hl[k, i, j])} if gain[k, place] > -np.inf else None
        out.append({"node": int(nodes[k]), "gt": float(gt[k, 0, 0]), "ht": float(ht[k, 0, 0]), "s": s})
    return out


def _best(rows: list, features: int, bins: int, share: float, least: float) -> list[dict]:
    """:func:`_folded` for all nodes on the driver."""
    return _folded(rows, features, bins, share, least)


def _splits(state: DataFrame, edges: list[list[float]], tree: dict, depth: int, share: float, least: float, tasks: int, most: int = _CELLS) -> list:
    """For every open node (f = -2) its sums and best split: the prefix of a column's bins with the largest gain, ties to the first column and bin.

    With the sums G and H of the derivatives, a side is worth G^2 / (H + share).
    ``state`` has chunks, or plain rows (b, n, pos, m).
    Each task folds its vectors to one sum a node, column and bin. At most ``most`` of them in all
    come to the driver as they are; more are folded by a shuffle, a few nodes in a group, and one row a node comes.
    """
    features, bins = len(edges), max(len(e) for e in edges) + 2
    chunked = isinstance(state.schema["b"].dataType, T.BinaryType)
    held = state.select("b", *(F.col(c) if chunked else F.col(c).cast("double") for c in ("n", "pos")), "m")
    sums = held.mapInArrow(_blocks(tree, depth, features, bins), "block int, task int, cell binary, g binary, h binary")
    if tree["f"].count(-2) * features * bins * tasks <= most:
        return _best(sums.collect(), features, bins, share, least)

    def fold(rows: pa.Table) -> pa.Table:
        s = pa.struct([("f", pa.int32()), ("bin", pa.int32()), ("gl", pa.float64()), ("hl", pa.float64())])
        found = _folded(rows.sort_by("task").to_pylist(), features, bins, share, least)
        return pa.Table.from_pylist(found, pa.schema([("node", pa.int32()), ("gt", pa.float64()), ("ht", pa.float64()), ("s", s)]))

    return sums.groupBy("block").applyInArrow(fold, "node int, gt double, ht double, s struct<f:int,bin:int,gl:double,hl:double>").collect()


def _grow(state: DataFrame, edges: list[list[float]], depth: int, rate: float, share: float, least: float, tasks: int) -> dict:
    """One tree, level by level; it ends where no node gains."""
    tree = {"f": [-2], "at": [0], "cut": [0.0], "left": [0], "value": [0.0]}
    for level in range(depth + 1):
        # below the last level only sums would be asked for, and the split above has told them
        if level == depth and depth:
            break
        splits = _splits(state, edges, tree, level, share, least, tasks)
        tree["f"] = [max(f, -1) for f in tree["f"]]
        for r in sorted(splits, key=lambda r: r["node"]):
            k, s = r["node"], r["s"]
            tree["value"][k] = -rate * r["gt"] / (r["ht"] + share)
            if s is None or depth == 0:
                continue
            tree["f"][k], tree["at"][k], tree["cut"][k], tree["left"][k] = s["f"], s["bin"], edges[s["f"]][s["bin"]], len(tree["f"])
            for g, h in ((s["gl"], s["hl"]), (r["gt"] - s["gl"], r["ht"] - s["hl"])):
                # a node whose sum cannot make two sides is a leaf at once
                for name, value in (("f", -2 if h >= 2 * least else -1), ("at", 0), ("cut", 0.0), ("left", 0), ("value", -rate * g / (h + share))):
                    tree[name].append(value)
        if -2 not in tree["f"]:
            break
    tree["f"] = [max(f, -1) for f in tree["f"]]
    return tree


def fit(df: DataFrame, cols: list[str], label: str, rounds: int = 100, depth: int = 10, rate: float = 0.3, share: float = 1.0, least: float = 1.0, bins: int = 256, written: int = 10) -> BoostedTrees:
    """M3: the model of :func:`fit_scored` alone."""
    return _fit(df, cols, label, rounds, depth, rate, share, least, bins, written, None)


def fit_scored(df: DataFrame, cols: list[str], label: str, rounds: int = 100, depth: int = 10, rate: float = 0.3, share: float = 1.0, least: float = 1.0, bins: int = 256, written: int = 10) -> tuple[BoostedTrees, DataFrame]:
    """M3: the model, and ``score, label, weight``: what it gives its training rows, which the training has told already.

    A row stands for ``weight`` training rows of equal bins and label.
    """
    told = scratch(df.sparkSession, "boosting-scores")
    model = _fit(df, cols, label, rounds, depth, rate, share, least, bins, written, told)
    return model, df.sparkSession.read.schema(_TOLD).parquet(told)


def _fit(df: DataFrame, cols: list[str], label: str, rounds: int, depth: int, rate: float, share: float, least: float, bins: int, written: int, told: str | None) -> BoostedTrees:
    """``rounds`` trees of at most ``depth`` levels on the log loss, by first and second derivatives.

    ``rate`` shrinks a leaf, ``share`` is added to its second derivatives and ``least`` is the smallest sum of
    them on a side; the defaults are the usual ones of such learners. Rows without a label are left out; nulls
    and NaN of a column share its last bin. Repeated rows weigh as often as they come, equal gains go to the first column, and nothing is drawn.
    Without any row, or with one class, the trees say what the labels say. Log odds are kept in a table that
    is written every ``written`` rounds, so a lost executor costs at most these.
    ``told`` names a folder for the scores of the training rows.
    """
    spark, y = df.sparkSession, F.col(label).cast("int")
    ready = df.where(y.isNotNull())
    edges = bin_edges(ready, cols, bins)
    vector = F.array(*(bin_of(F.col(c).cast("double"), e).cast("int") for c, e in zip(cols, edges, strict=True)))
    cells = ready.groupBy(vector.alias("b")).agg(F.count("*").alias("n"), F.count_if(y == 1).alias("pos"))
    path = scratch(spark, "boosting")
    features, size = len(cols), max(len(e) for e in edges) + 2
    cells.mapInArrow(_packed(features, size), "b binary, n binary, pos binary, rows long, ones long").write.parquet(f"{path}/cells")
    chunks = spark.read.parquet(f"{path}/cells")
    n, pos = chunks.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.sum("ones"), F.lit(0))).head()
    odds = min(max(pos / n if n else 0.0, 1e-6), 1 - 1e-6)
    base = math.log(odds / (1 - odds))
    tasks = chunks.rdd.getNumPartitions()
    start = {"f": [-1], "at": [0], "cut": [0.0], "left": [0], "value": [base]}
    state = chunks.select("b", "n", "pos", F.lit(None).cast("binary").alias("m")).mapInArrow(_moved(start, 0, features, size), _CHUNKS).persist()
    trees: list[dict] = []
    past: list[DataFrame] = []
    try:
        for k in range(rounds if n else 0):
            tree = _grow(state, edges, depth, rate, share, least, tasks)
            trees.append(tree)
            for old in past:  # this tree's first job has read all of ``state``
                old.unpersist()
            past.clear()
            if k + 1 == rounds and told is None:
                break
            after = state.mapInArrow(_moved(tree, depth, features, size), _CHUNKS)
            if (k + 1) % written == 0:
                after.write.parquet(f"{path}/round-{k + 1}")
                after = spark.read.parquet(f"{path}/round-{k + 1}")
                tasks = after.rdd.getNumPartitions()
            past.append(state)
            state = after.persist()
        if told is not None:
            state.mapInArrow(_told(features, size), _TOLD).write.parquet(told)
    finally:
        for old in (*past, state):
            old.unpersist()
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    return BoostedTrees(list(cols), base, depth, trees)


def score(model: BoostedTrees, df: DataFrame, name: str = "risk_score") -> DataFrame:
    """Adds the probability of label 1; values that are null or NaN go right in every tree."""
    x = ", ".join(f"CAST(`{c}` AS DOUBLE)" for c in model.cols)
    return df.withColumn(name, model.score(f"array({x})").cast("float"))
