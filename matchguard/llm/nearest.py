"""Approximate nearest neighbours by an inverted multi-index.

The two halves of a vector are quantised separately, and the product of the two
codebooks is a grid of cells that partitions all vectors. A query walks the
cells in the order of the summed squared distances of its halves to the cells'
centroids, with a heap (the multi-sequence order), until the entries of the
cells that it passed reach the list length that was learned; the entries of
those cells are ranked by exact Euclidean distance in double precision.

The codebooks come from at most ``sample`` distinct vectors and the list length
from at most ``probes`` of them, in hash order (documented bounds). A probe's
true neighbours are found among all entries by brute force, and the list length
is the one at which the probes' mean recall reaches ``recall``: so recall is
measured on every table, at its own density. Every row is indexed.

Equal vectors are one entry with its k + 1 smallest ids, and queries with equal
vectors are one query, so a vector that a third of all rows hold costs one
entry. Cells are cut into blocks of at most ``BLOCK`` entries: small cells
share a block, a hot cell is spread over many, and a block's queries are dealt
in parts as well. A block gives at most k + 1 rows a query.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
components, and rows without an id, take no part; vectors of another length are
no candidates; a candidate that a query's id names is the query's own row;
repeated rows are one; ties go to the smaller id; fewer candidates than k give
all of them; an empty table gives an empty result; other columns are not read.
Equal vectors are recognised by a 64-bit hash (two unlike ones are taken for one
with probability about 2^-64 a pair).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, join_spread, materialize, slices
from .embed_dedup import k_means, multi_sequence, squared

#: Entries and queries that meet in one part of a block.
BLOCK, BLOCK_QUERIES = 4096, 4096
#: Values are cut to this size for cells only, so that squares stay finite; distances use the vectors as they are.
HUGE = 1e100


def distances(entries: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows to one vector in double precision, safe for tiny and huge values."""
    with np.errstate(over="ignore", under="ignore"):
        apart = entries - query
        out = np.sqrt((apart * apart).sum(1))
        odd = np.flatnonzero(~((out > 1e-140) & (out < 1e150)))
        for i in odd:  # equal, or beyond what squares can hold
            top = np.abs(apart[i]).max()
            if top > 0 and np.isfinite(top):
                scaled = apart[i] / top
                out[i] = top * math.sqrt((scaled * scaled).sum())
    return out


@dataclass
class Grid:
    """Codebooks of one vector length, and where the entries of each cell lie."""

    first: np.ndarray
    second: np.ndarray
    sizes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    block: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    parts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    length: float = math.inf

    def costs(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x, cut = np.clip(x, -HUGE, HUGE), self.first.shape[1]
        return squared(x[:, :cut], self.first), squared(x[:, cut:], self.second)

    def homes(self, x: np.ndarray) -> np.ndarray:
        d1, d2 = self.costs(x)
        return d1.argmin(1) * len(self.second) + d2.argmin(1)

    def fill(self, cells: np.ndarray, counts: np.ndarray) -> None:
        """Take the entries of each cell: small neighbours share a block, a cell of more than ``BLOCK`` has blocks of its own."""
        self.sizes = np.zeros(len(self.first) * len(self.second), np.int64)
        self.sizes[cells] = counts
        self.parts = np.maximum(1, -(-self.sizes // BLOCK))
        self.block = np.zeros_like(self.sizes)
        at, held = 0, 0
        for cell, n in enumerate(self.sizes.tolist()):
            if held and held + n > BLOCK:
                at, held = at + 1, 0
            self.block[cell] = at
            held += n
            if n > BLOCK:
                at, held = at + int(self.parts[cell]), 0

    @property
    def weight(self) -> np.ndarray:
        """What a cell adds to the list length: its entries, but a hot cell no more than 16 usual ones."""
        used = self.sizes[self.sizes > 0]
        return np.minimum(self.sizes, 16 * max(1, math.ceil(used.sum() / max(1, len(used)))))

    def walk(self, d1: np.ndarray, d2: np.ndarray) -> Iterator[tuple[int, float]]:
        """Cells that hold entries, nearest first, and the weight of those before."""
        before, width, sizes, weight = 0, len(self.second), self.sizes, self.weight
        left = int((sizes > 0).sum())
        for i, j, _ in multi_sequence(d1, d2):
            cell = i * width + j
            if sizes[cell]:
                yield cell, before
                before += int(weight[cell])
                left -= 1
                if not left:
                    return

    def visited(self, d1: np.ndarray, d2: np.ndarray, least: int) -> list[int]:
        """The cells of a query: up to the list length, and further while they hold fewer than ``least`` entries."""
        out, seen = [], 0
        for cell, before in self.walk(d1, d2):
            if before >= self.length and seen >= least:
                break
            out.append(cell)
            seen += int(self.sizes[cell])
        return out


def _usable(embedding: Column) -> Column:
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return embedding.isNotNull() & (F.size(embedding) > 0) & finite & F.exists(embedding, lambda x: x != 0)


def _matrix(column: pa.Array) -> np.ndarray:
    """The lists of a column, of one length and without nulls, as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _by_length(batch: pa.RecordBatch, dim: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    lengths = batch.column(dim).to_numpy(zero_copy_only=False)
    for n in np.unique(lengths):
        yield int(n), batch.take(pa.array(np.flatnonzero(lengths == n)))


def _homes(shared) -> Callable:
    """Adds the home cell: node, ids, embedding, dim -> and cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2048):
            for dim, part in _by_length(batch, 3):
                cells = shared.value[dim].homes(_matrix(part.column(2)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cells, pa.int64())], names=["node", "ids", "embedding", "dim", "cell"])

    return run


def _nearest_of(shared, k: int) -> Callable:
    """Of a task's entries (node, embedding, dim, cell) the k nearest of each probe: (probe, dim, node, cell, distance)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        for batch in slices(batches, 2048):
            for dim, part in _by_length(batch, 2):
                own, probes = shared.value[dim]
                x, nodes, cells = _matrix(part.column(1)), part.column(0).to_numpy(), part.column(3).to_numpy()
                held = best.setdefault(dim, [(np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(own))
                for p in range(len(own)):
                    far = distances(x, probes[p])
                    far[nodes == own[p]] = np.inf
                    merged = [np.concatenate(v) for v in zip(held[p], (far, nodes, cells), strict=True)]
                    top = np.lexsort((merged[1], merged[0]))[:k]
                    held[p] = tuple(v[top] for v in merged)
        for dim, held in best.items():
            for p, (far, nodes, cells) in enumerate(held):
                there = np.isfinite(far)
                n = int(there.sum())
                if n:
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, p, np.int32)), pa.array(np.full(n, dim, np.int32)), pa.array(nodes[there]), pa.array(cells[there]), pa.array(far[there])], names=["probe", "dim", "node", "cell", "far"])

    return run


def _list_length(grid: Grid, probes: np.ndarray, true_cells: list[list[int]], recall: float) -> float:
    """The weight of cells to pass until a share ``recall`` of the probes' neighbours has been met."""
    needed = []
    d1, d2 = grid.costs(probes)
    for p, cells in enumerate(true_cells):
        missing = set(cells)
        for cell, before in grid.walk(d1[p], d2[p]):
            if cell in missing:
                missing.remove(cell)
                needed += [before + 1] * cells.count(cell)
                if not missing:
                    break
    if not needed:
        return math.inf
    return float(np.sort(needed)[min(len(needed) - 1, math.ceil(recall * len(needed)) - 1)])


def _visits(shared, k: int) -> Callable:
    """Queries (node, embedding, dim) -> one row for each block that holds visited cells: (node, embedding, dim, block, cells, size)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            for dim, part in _by_length(batch, 2):
                grid = shared.value[dim]
                d1, d2 = grid.costs(_matrix(part.column(1)))
                row, block, cells = [], [], []
                for q in range(part.num_rows):
                    met = np.array(grid.visited(d1[q], d2[q], k + 1), np.int64)
                    at = grid.block[met]
                    for b in np.unique(at):
                        own = met[at == b]
                        for more in range(int(grid.parts[own].max())):  # a hot cell has blocks of its own
                            row.append(q)
                            block.append(int(b) + more)
                            cells.append(own)
                out = part.take(pa.array(row, pa.int64()))
                yield pa.RecordBatch.from_arrays([*out.columns, pa.array(block, pa.int64()), pa.array(cells, pa.list_(pa.int64()))], names=["node", "embedding", "dim", "block", "cells"])

    return run


def _places(shared) -> Callable:
    """Entries -> their block: (node, ids, embedding, dim, cell, block)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            for dim, part in _by_length(batch, 3):
                grid, cells, nodes = shared.value[dim], part.column(4).to_numpy(), part.column(0).to_numpy()
                block = grid.block[cells] + nodes % grid.parts[cells]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(block, pa.int64())], names=[*part.schema.names, "block"])

    return run


def _ranked(k: int) -> Callable:
    """Rows sorted by (tile, query, cell): a tile's entries, then its queries; gives the k + 1 nearest ids of each query in the tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, vectors, cells, ids, x, spans = None, [], [], [], None, {}
        for batch in slices(batches, 1024):
            query, near, score = [], [], []
            flat, offsets = batch.column(4).values.to_numpy(zero_copy_only=False), batch.column(4).offsets.to_numpy()
            for r, (t, is_query, cell, node, own, visited) in enumerate(zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 3, 5, 6)), strict=True)):
                if t != tile:
                    tile, vectors, cells, ids, x = t, [], [], [], None
                v = flat[offsets[r] : offsets[r + 1]]
                if not is_query:
                    vectors.append(v)
                    cells.append(cell)
                    ids.append(own)
                    continue
                if not vectors:
                    continue
                if x is None:  # the entries lie by cell
                    x, starts = np.array(vectors), np.flatnonzero(np.diff(cells, prepend=-1))
                    spans = dict(zip(np.array(cells)[starts].tolist(), zip(starts.tolist(), [*starts[1:].tolist(), len(cells)], strict=True), strict=True))
                at = np.concatenate([np.arange(*spans[c]) for c in visited if c in spans] or [np.zeros(0, np.int64)])
                if not len(at):
                    continue
                far = distances(x[at], v)
                if len(far) > k + 1:
                    close = far <= np.partition(far, k)[k]
                    at, far = at[close], far[close]
                best = sorted((d, i) for d, a in zip(far.tolist(), at.tolist(), strict=True) for i in ids[a])[: k + 1]
                query += [node] * len(best)
                near += [i for _, i in best]
                score += [d for d, _ in best]
            if query:
                yield pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(near, pa.int64()), pa.array(score, pa.float64())], names=["node", "near", "score"])

    return run


def nearest(vectors: DataFrame, queries: Column, k: int = 10, recall: float = 0.97, sample: int = 20_000, probes: int = 256, codes: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest rows found for each row of ``vectors`` (vec_id, embedding) that ``queries`` picks."""
    spark = vectors.sparkSession
    named = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.coalesce(queries, F.lit(False)).alias("asks"))
    rows = named.where(F.col("vec_id").isNotNull() & _usable(F.col("embedding"))).withColumn("node", F.xxhash64("embedding"))
    # of each vector the k + 1 smallest ids: limited before the shuffle too
    few = rows.select("node", "vec_id", "embedding").withColumn("at", F.dense_rank().over(Window.partitionBy("node").orderBy("vec_id"))).where(F.col("at") <= k + 1)
    entries = few.groupBy("node").agg(F.array_sort(F.collect_set("vec_id")).alias("ids"), F.first("embedding").alias("embedding")).withColumn("dim", F.size("embedding"))
    entries = materialize(entries, "ann-entries")

    counts = {r["dim"]: r["count"] for r in entries.groupBy("dim").count().collect()}  # one row a vector length
    share = max(64, sample // max(1, len(counts)))
    chosen = entries.withColumn("at", F.row_number().over(Window.partitionBy("dim").orderBy(F.xxhash64("node"), "node"))).where(F.col("at") <= share)
    picked: dict[int, list] = {}
    for r in chosen.select("dim", "at", "node", "embedding").orderBy("dim", "at").collect():
        picked.setdefault(r["dim"], []).append(r)
    grids, asked = {}, {}
    for dim, own in picked.items():
        x = np.array([r["embedding"] for r in own], np.float64)
        cut, few_codes = (dim + 1) // 2, codes or int(min(share // 32, max(4, round(counts[dim] ** 0.5 / 4))))
        tame, alike = np.clip(x, -HUGE, HUGE), np.ones(len(x))
        grids[dim] = Grid(k_means(tame[:, :cut], few_codes, alike), k_means(tame[:, cut:], few_codes, alike, seed=6))
        n = max(8, probes // len(picked))
        asked[dim] = (np.array([r["node"] for r in own[:n]], np.int64), x[:n])
    books = spark.sparkContext.broadcast(grids)  # codebooks of at most ``sample`` / 16 half vectors
    housed = materialize(entries.mapInArrow(_homes(books), "node long, ids array<long>, embedding array<double>, dim int, cell long"), "ann-housed")
    sizes: dict[int, list] = {}
    for r in housed.groupBy("dim", "cell").count().collect():  # at most one row a cell of the grids
        sizes.setdefault(r["dim"], []).append((r["cell"], r["count"]))
    for dim, found in sizes.items():
        cells, n = zip(*found, strict=True)
        grids[dim].fill(np.array(cells), np.array(n))

    probed = spark.sparkContext.broadcast(asked)  # at most ``probes`` vectors, or 8 a length
    tops = housed.select("node", "embedding", "dim", "cell").mapInArrow(_nearest_of(probed, k), "probe int, dim int, node long, cell long, far double")
    tops = tops.withColumn("at", F.row_number().over(Window.partitionBy("dim", "probe").orderBy("far", "node"))).where(F.col("at") <= k)
    true: dict[int, dict[int, list[int]]] = {}
    for r in tops.select("dim", "probe", "cell").collect():  # k rows a probe
        true.setdefault(r["dim"], {}).setdefault(r["probe"], []).append(r["cell"])
    for dim, (_, x) in asked.items():
        grids[dim].length = _list_length(grids[dim], x, [true.get(dim, {}).get(p, []) for p in range(len(x))], recall)
    index = spark.sparkContext.broadcast(grids)  # and three numbers a cell

    asking = rows.where("asks").select("vec_id", "node").distinct()
    nodes = asking.select("node").distinct()
    visits = housed.join(nodes, "node", "left_semi").select("node", "embedding", "dim").mapInArrow(_visits(index, k), "node long, embedding array<double>, dim int, block long, cells array<long>")
    visits = materialize(visits, "ann-visits")
    deals = visits.groupBy("dim", "block").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("deals"))
    placed = housed.mapInArrow(_places(index), "node long, ids array<long>, embedding array<double>, dim int, cell long, block long")
    none = F.lit(None).cast("array<long>")
    members = placed.join(deals, ["dim", "block"]).withColumn("deal", F.explode(F.sequence(F.lit(0), F.col("deals") - 1)))
    members = members.select("dim", "block", "deal", F.lit(False).alias("query"), "cell", "node", "embedding", "ids", none.alias("cells"))
    callers = visits.join(deals, ["dim", "block"]).withColumn("deal", F.pmod(F.xxhash64("node"), "deals").cast("int"))
    callers = callers.select("dim", "block", "deal", F.lit(True).alias("query"), F.lit(0).cast("long").alias("cell"), "node", "embedding", none.alias("ids"), "cells")
    met = members.unionByName(callers).withColumn("tile", F.concat_ws(":", "dim", "block", "deal"))
    met = met.repartition("dim", "block", "deal").sortWithinPartitions("tile", "query", "cell", "node").select("tile", "query", "cell", "node", "embedding", "ids", "cells")
    found = met.mapInArrow(_ranked(k), "node long, near long, score double")
    best = found.withColumn("at", F.row_number().over(Window.partitionBy("node").orderBy("score", "near"))).where(F.col("at") <= k + 1)
    lists = materialize(best.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("score", "near"))).alias("list")), "ann-lists")
    discard(visits)
    answered = join_spread(asking, lists, "node", "vec_id").select(F.col("vec_id").alias("query_id"), F.slice(F.filter("list", lambda e: e["near"] != F.col("vec_id")), 1, k).alias("list"))
    each = answered.select("query_id", F.posexplode("list").alias("at", "e"))
    return each.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("e.near").alias("vec_id"), F.col("e.score").alias("score"))
