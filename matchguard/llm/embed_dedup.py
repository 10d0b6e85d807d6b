"""Embedding near-dedup by an inverted multi-index.

Unit vectors are cut in halves with a codebook each; the product of the
codebooks is a grid of cells, one grid for each label. A vector visits cells in
the order of a multi-sequence traversal (rising sum of the two halves' squared
distances) until the order passes its nearest cell by ``reach``, the excess that
finds the target share of the true pairs of a sample, where neither the size of
a group nor the closeness of its pairs has weight. Pairs in visited cells are
verified by cosine in double precision.

Neighbouring cells make a region, of which a label has a few, and a vector is
sent once to its own region and once to each other one that it visits, however
many cells it visits there: what is sent grows with the regions and not with the
grid. Each pair is looked for once, where one vector of the two visits the region
of the other. A region with too many vectors is cut into parts, which stand for
regions of their own, so a hot cell is spread over tasks. A task holds the
members of one part, in single precision as long as that tells a pair from the
threshold, and takes visitors in batches; it gives link counts and spanning
forests of links, never all pairs. Equal vectors of a label are one node with a count.

The codebooks and ``reach`` come from at most ``sample`` distinct vectors (a
documented bound, in hash order); all vectors are indexed.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
components, and rows without a label, link with nothing; vectors of different
lengths do not link; rows that repeat link with each other; a null id never
names a component unless all ids there are null; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, join_spread, materialize, slices
from .components import components, roots

#: Members of a part at most (of 64 components; fewer of longer ones), and visitors that a task takes at once.
TILE_MEMBERS, TILE_QUERIES = 262_144, 16_384
#: Parts that a table is cut into, if they have ``LEAST`` members then and not more than may be.
TILES, LEAST = 32, 1024
#: Rows of either side that are multiplied at once.
BLOCK = 1024


def unit(v: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, in double precision, safe for tiny and huge values."""
    v = np.asarray(v, np.float64)
    v = v / np.abs(v).max(axis=-1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=-1, keepdims=True))


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1), 0)


def k_means(x: np.ndarray, k: int, weight: np.ndarray, rounds: int = 12, seed: int = 5) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False, p=weight / weight.sum())]
    for _ in range(rounds):
        own = squared(x, c).argmin(1)
        n = np.bincount(own, weight, len(c))
        total = np.zeros_like(c)
        np.add.at(total, own, x * weight[:, None])
        c = np.where(n[:, None] > 0, total / np.where(n > 0, n, 1)[:, None], c)
    return c


def multi_sequence(d1: np.ndarray, d2: np.ndarray) -> Iterator[tuple[int, int, float]]:
    """Cells of the grid (code of each half) and their cost, cheapest first."""
    o1, o2 = d1.argsort(kind="stable"), d2.argsort(kind="stable")
    heap, seen = [(float(d1[o1[0]] + d2[o2[0]]), 0, 0)], {(0, 0)}
    while heap:
        cost, i, j = heapq.heappop(heap)
        yield int(o1[i]), int(o2[j]), cost
        for a, b in ((i + 1, j), (i, j + 1)):
            if a < len(o1) and b < len(o2) and (a, b) not in seen:
                seen.add((a, b))
                heapq.heappush(heap, (float(d1[o1[a]] + d2[o2[b]]), a, b))


@dataclass
class MultiIndex:
    """Codebooks of the halves of one vector length, and how far a traversal goes."""

    first: np.ndarray
    second: np.ndarray
    reach: float = 0.0
    region: np.ndarray | None = None  # of each cell

    def regions(self, cells: np.ndarray) -> np.ndarray:
        return np.zeros(len(cells), np.int64) if self.region is None else self.region[cells]

    def costs(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.first.shape[1]
        return squared(x[:, :cut], self.first), squared(x[:, cut:], self.second)

    def homes(self, x: np.ndarray) -> np.ndarray:
        d1, d2 = self.costs(x)
        return d1.argmin(1) * len(self.second) + d2.argmin(1)

    def visited(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) for the prefix of each row's multi-sequence traversal that ``reach`` allows.

        The prefix is a staircase under the two sorted cost lists: with the i-th
        cheapest code of the first half go the codes of the second half that
        cost no more than what is left. It is read off without a heap.
        """
        d1, d2 = self.costs(x)
        o1, o2 = d1.argsort(1), d2.argsort(1)
        s1, s2 = np.take_along_axis(d1, o1, 1), np.take_along_axis(d2, o2, 1)
        left = s1[:, :1] + s2[:, :1] + self.reach + 1e-12 - s1
        rows, cells = [], []
        for i in range(s1.shape[1]):
            n = (s2 <= left[:, i : i + 1]).sum(1)
            live = np.flatnonzero(n)
            if not len(live):
                break
            r = np.repeat(live, n[live])
            j = np.arange(len(r)) - np.repeat(np.cumsum(n[live]) - n[live], n[live])
            rows.append(r)
            cells.append(o1[r, i] * len(self.second) + o2[r, j])
        return np.concatenate(rows), np.concatenate(cells)


def _links(sample: np.ndarray, labels: np.ndarray, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(x, y, their cosine) for all ordered pairs of different vectors that link, in bounded blocks."""
    for label in np.unique(labels):
        own = np.flatnonzero(labels == label)
        for a in range(0, len(own), 128):
            close = sample[own[a : a + 128]] @ sample[own].T
            x, y = np.nonzero(close >= cosine)
            x, y, close = own[a : a + 128][x], own[y], close[x, y]
            apart = x != y
            yield x[apart], y[apart], close[apart]


BINS = 1e-4 * np.arange(40_001)


def leads(a, b):
    """Whether a vector of region (or part) ``a`` visits ``b`` or the other way round; each is visited by about half of the others."""
    return (a < b) == ((a + b) % 2 == 1)


def _regions(index: MultiIndex, homes: np.ndarray, regions: int) -> np.ndarray:
    """For each cell the region that it belongs to: near cells together, weighed by the sample's vectors in them."""
    k1, k2 = len(index.first), len(index.second)
    cells = np.concatenate([np.repeat(index.first, k2, axis=0), np.tile(index.second, (k1, 1))], axis=1)
    centres = k_means(cells, regions, np.bincount(homes, minlength=k1 * k2) + 1e-3, seed=7)
    return squared(cells, centres).argmin(1)


def fit_index(sample: np.ndarray, labels: np.ndarray, codes: int, cosine: float, recall: float, regions: int = 1) -> MultiIndex:
    """Codebooks and regions from unit vectors, and the reach that finds ``recall`` of the sample's true pairs.

    Pair counts have no weight. In the codebooks a vector weighs one over its
    links and itself, so a group of near copies takes about one code. Between
    two cells an excess is at most linear in the distance of the pair, so each
    is scaled to a pair at the threshold. The reach is the larger of two
    quantiles of these: with each vector counted once, and each group once.
    """
    cut = (sample.shape[1] + 1) // 2
    degree = np.zeros(len(sample), np.int64)
    for x, _, _ in _links(sample, labels, cosine):
        degree += np.bincount(x, minlength=len(sample))
    weight = 1 / (1.0 + degree)
    index = MultiIndex(k_means(sample[:, :cut], codes, weight), k_means(sample[:, cut:], codes, weight, seed=6))
    homes, by_vector, by_group = index.homes(sample), np.zeros(len(BINS)), np.zeros(len(BINS))
    if regions > 1:
        index.region = _regions(index, homes, regions)
    region = index.regions(homes)
    for x, y, close in _links(sample, labels, cosine):
        ahead = np.where(region[x] == region[y], homes[x] < homes[y], leads(region[x], region[y]))
        x, y, close = x[ahead], y[ahead], close[ahead]
        if len(x):
            rows, k = np.unique(x, return_inverse=True)
            d1, d2 = index.costs(sample[rows])
            excess = d1[k, homes[y] // len(index.second)] + d2[k, homes[y] % len(index.second)] - (d1.min(1) + d2.min(1))[k]
            scaled = excess * np.sqrt((1 - cosine) / np.maximum(1 - close, 1e-9)) if cosine < 1 else excess
            at = np.minimum(np.searchsorted(BINS, scaled), len(BINS) - 1)
            by_vector += np.bincount(at, 1 / degree[x] + 1 / degree[y], len(BINS))
            by_group += np.bincount(at, 1 / (degree[x] * degree[y]), len(BINS))
    index.reach = max((float(BINS[np.searchsorted(np.cumsum(w), recall * w.sum())]) for w in (by_vector, by_group) if w.any()), default=0.0)
    if by_group.sum() < 10:  # too few groups to learn from: at least twice the mean excess of vectors at that cosine
        index.reach = max(index.reach, 4 * (1 - cosine))
    return index


def _clean(vector: list | None) -> np.ndarray | None:
    if not vector or any(x is None for x in vector):
        return None
    v = np.array(vector, np.float64)
    return v if np.isfinite(v).all() and v.any() else None


def _vectors(column: pa.Array) -> list[np.ndarray | None]:
    """The usable vectors of a list column in double precision."""
    if column.null_count or column.values.null_count:
        return [_clean(v) for v in column.to_pylist()]
    values, offsets = column.values.to_numpy(zero_copy_only=False).astype(np.float64), column.offsets.to_numpy().tolist()
    cut = (values[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True))
    return [v if len(v) and np.isfinite(v).all() and v.any() else None for v in cut]


def _nodes(kind: np.dtype | None) -> Callable:
    """An Arrow function: (vec_id, node) of each row, the node of a usable vector being a hash of label and values; or, with the ``kind`` of number that holds the values, (node, label, vector as bytes, dim) of the usable ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2048):
            labels = batch.column(2).to_pylist()
            found = [v if label is not None else None for v, label in zip(_vectors(batch.column(1)), labels, strict=True)]
            nodes = [None if v is None else int(np.uint64(xxhash.xxh3_64_intdigest(v.tobytes() + label.to_bytes(8, "little", signed=True))).astype(np.int64)) for v, label in zip(found, labels, strict=True)]
            if kind is None:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(nodes, pa.int64())], names=["vec_id", "node"])
                continue
            own = [i for i, v in enumerate(found) if v is not None]
            columns = [pa.array([nodes[i] for i in own], pa.int64()), pa.array([labels[i] for i in own], pa.int64()), pa.array([found[i].astype(kind).tobytes() for i in own], pa.binary()), pa.array([len(found[i]) for i in own], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "label", "vector", "dim"])

    return run


def _matrix(column: pa.Array, kind: np.dtype, dim: int) -> np.ndarray:
    """The vectors of a binary column, all of one length, as rows of one array."""
    first = np.frombuffer(column.buffers()[1], np.int32)[column.offset]
    return np.frombuffer(column.buffers()[2], kind, len(column) * dim, int(first)).reshape(-1, dim)


def _by_dim(batch: pa.RecordBatch, dims: pa.Array) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The rows of each vector length."""
    dims = dims.to_numpy()
    for dim in np.unique(dims).tolist():
        yield dim, batch if (dims == dim).all() else batch.take(pa.array(np.flatnonzero(dims == dim)))


def _homes(indexes: dict[int, MultiIndex], kind: np.dtype) -> Callable:
    """Of each node (label, dim, vector) its label, dim and region."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2048):
            for dim, part in _by_dim(batch, batch.column(1)):
                index = indexes[dim]
                region = index.regions(index.homes(unit(_matrix(part.column(2), kind, dim))))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(region, pa.int32())], names=["label", "dim", "region"])

    return run


def _dealt(indexes: dict[int, MultiIndex], kind: np.dtype) -> Callable:
    """Of each node (node, label, copies, dim, vector): its row as a member of its home cell's region, and one row for each other region that it visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 512):
            for dim, part in _by_dim(batch, batch.column(3)):
                u, index = unit(_matrix(part.column(4), kind, dim)), indexes[dim]
                home = index.homes(u)
                own = index.regions(home)
                row, region = np.arange(len(u)), own
                if index.region is not None:
                    at, cell = index.visited(u)
                    there = index.region[cell]
                    keep = (there != own[at]) & leads(own[at], there)
                    met = np.unique(at[keep] * (1 + index.region.max()) + there[keep])
                    row, region = np.concatenate([row, met // (1 + index.region.max())]), np.concatenate([own, met % (1 + index.region.max())])
                out = part.take(pa.array(row))
                visits = np.arange(len(row)) >= len(u)
                yield pa.RecordBatch.from_arrays([out.column(1), out.column(3), pa.array(region, pa.int32()), pa.array(visits), pa.array(home[row], pa.int32()), out.column(0), out.column(2), out.column(4)], names=["label", "dim", "region", "visits", "cell", "node", "copies", "vector"])

    return run


DEGREE, EDGE = 0, 1


def _found(kind: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["kind", "a", "b"])


class _Part:
    """The members of one part of a region, by cell, and their links."""

    def __init__(self, index: MultiIndex, cosine: float, cell: np.ndarray, node: np.ndarray, copies: np.ndarray, vector: np.ndarray):
        self.index, self.cosine, self.cell, self.node, self.copies, self.vector = index, cosine, cell, node, copies, vector
        self.near = np.empty(vector.shape, np.float32)
        for i in range(0, len(vector), 4096):
            self.near[i : i + 4096] = unit(vector[i : i + 4096])
        self.degree = np.zeros(len(node), np.int64)
        self.cells, first = np.unique(cell, return_index=True)
        self.first = np.append(first, len(cell))
        # what single precision may be off by
        self.margin = (vector.shape[1] + 4) * 2.0**-23

    def _block(self, x: np.ndarray, u: np.ndarray, low: int, high: int) -> np.ndarray:
        """Which of some rows (unit vectors, in both precisions) link with the members from ``low`` to ``high``."""
        c = x @ self.near[low:high].T
        link = c >= self.cosine - self.margin
        if link.any():
            i, j = np.nonzero(link & (c <= self.cosine + self.margin))
            for k in range(0, len(i), BLOCK * 16):
                a, b = i[k : k + BLOCK * 16], j[k : k + BLOCK * 16]
                link[a, b] = np.einsum("ij,ij->i", u[a], unit(self.vector[low + b])) >= self.cosine
        return link

    def meet(self, node: np.ndarray, copies: np.ndarray, vector: np.ndarray, start: int | None = None) -> Iterator[pa.RecordBatch]:
        """Links of visitors; or, with ``start``, of the members from there on with those behind them: in their own cell and in later ones."""
        u = unit(vector)
        x, degree, tails, heads = u.astype(np.float32), np.zeros(len(node), np.int64), [], []
        row, cell = self.index.visited(u)
        if start is not None:
            home = self.cell[start : start + len(node)]
            later = cell > home[row]
            row, cell = np.concatenate([np.arange(len(node)), row[later]]), np.concatenate([home, cell[later]])
        at = np.searchsorted(self.cells, cell)
        here = np.flatnonzero(self.cells[np.minimum(at, len(self.cells) - 1)] == cell)
        here = here[np.argsort(at[here], kind="stable")]
        at, row = at[here], row[here]
        ends = np.append(np.flatnonzero(np.diff(at, prepend=-1)), len(at))
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            first, last = int(self.first[at[a]]), int(self.first[at[a] + 1])
            for i in range(a, b, BLOCK):
                r = row[i : min(i + BLOCK, b)]
                own = None if start is None else np.flatnonzero(self.cell[start + r] == self.cells[at[a]])
                xs, us = x[r], u[r]
                for low in range(first, last, BLOCK):
                    high = min(low + BLOCK, last)
                    if own is not None and len(own) == len(r) and high <= start + r[0]:
                        continue
                    link = self._block(xs, us, low, high)
                    if own is not None and len(own):
                        link[own] &= np.arange(low, high) > (start + r[own])[:, None]
                    if not link.any():
                        continue
                    degree[r] += link @ self.copies[low:high]
                    self.degree[low:high] += link.T @ copies[r]
                    q, m = np.nonzero(link)
                    nodes, root = roots(node[r[q]], self.node[low + m])
                    tails.append(nodes[nodes != root])
                    heads.append(root[nodes != root])
        if start is not None:
            self.degree[start : start + len(node)] += degree
        elif degree.any():
            yield _found(DEGREE, node[degree > 0], degree[degree > 0])
        if tails:
            nodes, root = roots(np.concatenate(tails), np.concatenate(heads))
            yield _found(EDGE, nodes[nodes != root], root[nodes != root])

    def inner(self) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(self.node), TILE_QUERIES):
            own = slice(i, i + TILE_QUERIES)
            yield from self.meet(self.node[own], self.copies[own], self.vector[own], i)

    def degrees(self) -> pa.RecordBatch:
        return _found(DEGREE, self.node[self.degree > 0], self.degree[self.degree > 0])


def _parts(indexes: dict[int, MultiIndex], kind: np.dtype, cosine: float) -> Callable:
    """Rows sorted by part, members first and by cell; gives (DEGREE, node, links) and (EDGE, node, root) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple | None = None
        held: list[tuple] = []
        part: _Part | None = None

        def closed() -> Iterator[pa.RecordBatch]:
            """The members are complete: their links among themselves."""
            nonlocal part
            if held:
                part = _Part(indexes[now[1]], cosine, *(np.concatenate(c) for c in zip(*held, strict=True)))
                held.clear()
                yield from part.inner()

        for batch in slices(batches, TILE_QUERIES):  # label, dim, region, part, visits, cell, node, copies, vector
            keys = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(5)])
            ends = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
            for a, b in zip(ends[:-1], ends[1:], strict=True):
                if a == b:
                    continue
                key, rows = tuple(keys[a].tolist()), batch.slice(a, b - a)
                if key[:4] != now:
                    yield from closed()
                    if part is not None:
                        yield part.degrees()
                    now, part = key[:4], None
                cell, node, copies = (rows.column(i).to_numpy() for i in (5, 6, 7))
                vector = _matrix(rows.column(8), kind, key[1])
                if not key[4]:
                    held.append((cell, node, copies, vector))
                    continue
                yield from closed()
                if part is not None:  # else nothing lies there
                    yield from part.meet(node, copies, vector)
        yield from closed()
        if part is not None:
            yield part.degrees()

    return run


def near_duplicates(vectors: DataFrame, cosine: float = 0.93, recall: float = 0.985, sample: int = 20_000, codes: int | None = None, exact: bool = False) -> DataFrame:
    """Per row of ``vectors`` (vec_id, embedding, label): ``vec_id, n_links, component_id, kept``.

    ``exact`` compares all vectors of a label (a grid of one cell, in the same
    bounded parts): whole recall, for a time that grows with the square.
    """
    spark = vectors.sparkSession
    held = getattr(vectors.schema["embedding"].dataType, "elementType", None)
    kind = np.dtype("<f4" if isinstance(held, T.FloatType) else "<f8")
    named = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), (F.col("embedding") if kind.itemsize == 4 else F.col("embedding").cast("array<double>")).alias("embedding"), F.col("label").cast("long").alias("label"))
    rows = materialize(named.mapInArrow(_nodes(None), "vec_id long, node long"), "imi-rows")
    usable = named.mapInArrow(_nodes(kind), "node long, label long, vector binary, dim int")
    nodes = materialize(usable.groupBy("node").agg(F.first("label").alias("label"), F.first("vector").alias("vector"), F.count("*").alias("copies"), F.first("dim").alias("dim")), "imi-nodes")
    sizes = nodes.groupBy("label", "dim").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.sum(F.col("n").cast("double") * F.col("n")).alias("squares")).head()
    n = sizes["n"]
    # the sample are the least in hash order; the bound lets half as many again through
    place = F.xxhash64("node")
    some = nodes if n <= 2 * sample else nodes.where(place < int(-(2**63) + 1.5 * sample / n * 2**64))
    chosen = some.orderBy(place, "node").limit(sample).select("dim", "label", "vector").collect()
    indexes = {}
    if exact:
        codes = 1
    if codes is None:  # the grid grows with the table, as far as the sample can teach it; a finer one makes a vector visit more cells for fewer comparisons
        codes = int(min(sample // 8, 256, max(4, round(n ** (1 / 4)))))
    lengths = {r["dim"] for r in nodes.select("dim").distinct().collect()}
    most = max(1, min(TILE_MEMBERS * 64 // max(64, *lengths, 64), max(LEAST, n // TILES)))
    regions = min(codes * codes, math.ceil(sizes["squares"] / n / most)) if n else 1  # for the label of a vector's mean
    for dim in lengths:
        own = [r for r in chosen if r["dim"] == dim] or nodes.where(F.col("dim") == dim).select("dim", "label", "vector").limit(100).collect()
        indexes[dim] = fit_index(unit(np.stack([np.frombuffer(r["vector"], kind) for r in own])), np.array([r["label"] for r in own]), codes, cosine, recall, regions)
    shared = spark.sparkContext.broadcast(indexes)  # two codebooks of at most sample / 8 half vectors, for each vector length, and a region a cell

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _homes(shared.value, kind)(batches)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _dealt(shared.value, kind)(batches)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _parts(shared.value, kind, cosine)(batches)

    key = ["label", "dim", "region"]
    # regions of too many members, of which there are fewer than n / most
    large = nodes.select("label", "dim", "vector").mapInArrow(home, "label long, dim int, region int").groupBy(*key).agg(F.count("*").alias("m")).where(F.col("m") > most)
    large = materialize(large.select(*key, F.ceil(F.col("m") / most).cast("int").alias("cuts")), "imi-large")
    dealt = nodes.select("node", "label", "copies", "dim", "vector").mapInArrow(deal, "label long, dim int, region int, visits boolean, cell int, node long, copies long, vector binary")
    dealt = dealt.join(F.broadcast(large), key, "left").withColumn("cuts", F.coalesce("cuts", F.lit(1)))
    # a visitor meets all parts of the region, a member its own as such and about half of the others as a visitor
    own = F.pmod(F.xxhash64("node"), "cuts").cast("int")
    met = F.filter(F.sequence(F.lit(0), F.col("cuts") - 1), lambda j: F.col("visits") | (j == own) | leads(own, j))
    dealt = dealt.withColumn("part", F.explode(met)).withColumn("visits", F.col("visits") | (F.col("part") != own))
    order = [*key, "part", "visits", "cell"]
    tiled = dealt.repartition(*key, "part").sortWithinPartitions(*order).select(*order, "node", "copies", "vector")
    found = materialize(tiled.mapInArrow(compare, "kind int, a long, b long"), "imi-found")
    discard(large)
    comps = components(found.where(F.col("kind") == EDGE).select("a", "b"), "imi-components")
    degrees = found.where(F.col("kind") == DEGREE).groupBy("a").agg(F.sum("b").alias("links")).withColumnRenamed("a", "node")
    known = nodes.select("node", "copies").join(degrees, "node", "left").join(comps, "node", "left").select("node", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("class"))
    classed = join_spread(rows.select("vec_id", "node"), known, "node", "vec_id")
    least = classed.where("class is not null").groupBy("class").agg(F.min("vec_id").alias("least"))
    out = join_spread(classed, least, "class", "vec_id").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("least", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
