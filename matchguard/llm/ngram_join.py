"""N-gram Jaccard join by parity sketches.

A document's set of five-word shingles is hashed into a sketch of m words: every
shingle XORs its hash into one word. Two sketches differ in at most as many words
as the sets have elements on one side only, so a pair whose symmetric difference
is at most D agrees on at least m - D words. With m = D + 1 + slack for each size
band, one equal word at least makes such a pair a candidate (pigeonhole); sets
are then compared exactly.

Of the m words at least ``slack`` + 1 are equal, so each set leaves out ``slack``
of them, in one order for all sets: first words no shingle fell into, then those
that most sets share (passages found in many documents). Two sets that link
still have an equal word among the rest: sorted the other way round, the first
m - slack words of both must meet (prefix filter).

A set is compared with three at most of its groups' smallest sets, those it meets
most often, which grows with the sets and not with a square: first by the Hamming distance of dense bit
sketches (every shingle flips one bit), then, if that is small enough, by the
texts. Sets of groups that still hold several components after that meet once
more, by the places of their rarest shingles and again by Hamming distance
(``_crossing``), which loses no link; only pairs near the threshold come out.

Equal sets have one node, the hash of the set, so copies cost one comparison.

Defined results: null, empty and blank texts have an empty set, link with
nothing and are their own component; under five words the whole sequence is one
shingle; texts of any length are read whole (a set has up to 2^40 shingles, all
of one text in one task's memory); a null id takes part but never names a component unless all ids there
are null; rows that repeat an id are rows of one component only if their sets
link; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import functools
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, is_empty, join_spread, materialize, slices
from .components import components

WORDS = 5
RATIO = 1.3
#: Groups up to this size are counted while they stream by; larger ones by a group-by.
BUFFER = 8192
#: Base of the polynomial that hashes words, and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_LOWER, _GAP = LOWER.tobytes(), SPACE.tobytes()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = 1 << n.bit_length()
        for i, base in enumerate((BASE, INVERSE)):
            out = np.full(size, base, np.uint64)
            out[0] = 1
            _POWERS[i] = np.multiply.accumulate(out)
    return _POWERS[0], _POWERS[1]


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of every word of lower-cased UTF-8 bytes."""
    lower = data.translate(_LOWER)  # bytes by table: a tenth of the time of looking up an array
    raw = np.frombuffer(lower, np.uint8)
    gap = np.frombuffer(b"\1" + lower.translate(_GAP) + b"\1", bool)
    turn = np.flatnonzero(gap[1:] != gap[:-1])
    start, end = turn[::2], turn[1::2]
    if not len(start):
        return np.zeros(0, np.uint64)
    power, back = _powers(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    value = np.take(_VALUE, raw)
    value *= power[: len(raw)]
    np.cumsum(value, out=total[1:])
    return mix((total[end] - total[start]) * back[start] + (end - start).astype(np.uint64))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles."""
    w = word_hashes((text or "").encode())
    if not len(w):
        return w
    k = min(words, len(w))
    h = np.full(len(w) - k + 1, k, np.uint64)
    for j in range(k):
        h = h * np.uint64(BASE) + w[j : len(w) - k + 1 + j]
    return np.unique(mix(h))


def node_of(s: np.ndarray) -> int | None:
    """The node of a set: a signed 64-bit hash of it; None for the empty set."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).astype(np.int64)) if len(s) else None


def read_bits(data: bytes) -> tuple[int, np.ndarray]:
    return int.from_bytes(data[:8], "little"), np.frombuffer(data, np.uint64, offset=8)


class Bands:
    """Size bands and the sketch length of each, for links of similarity ``percent`` / 100 or more."""

    def __init__(self, percent: int = 80, largest: int = 1 << 40):
        self.percent, low = percent, [1]
        while low[-1] <= largest:
            low.append(max(low[-1] + 1, int(np.ceil(low[-1] * RATIO))))
        self.low = np.array(low)
        top = self.low[1:] - 1
        both = top + top * 100 // percent  # the largest sizes of a pair that meets in the band
        #: largest symmetric difference of such a pair
        self.gap = (100 - percent) * both // (100 + percent)
        #: words that each set may leave out: enough for those inside a passage that is a third of the set
        self.slack = np.maximum(1, (self.gap + 1) // 2)
        self.words = self.gap + 1 + self.slack

    def of(self, n: int) -> list[int]:
        """The bands where a set of ``n`` meets its partners: its own, and those of smaller sets near enough."""
        near = -(-n * self.percent // 100)
        k, lowest = (int(np.searchsorted(self.low, x, "right")) - 1 for x in (n, near))
        return list(range(k, lowest - 1, -1))

    def empty(self, s: np.ndarray, band: int) -> int:
        """Words of the sketch that no shingle falls into."""
        m = int(self.words[band])
        return m - len(np.unique((s >> np.uint64(20)) % np.uint64(m)))

    def linked(self, common: int, a: int, b: int) -> bool:
        return 100 * common >= self.percent * (a + b - common)

    def bits(self, s: np.ndarray) -> bytes:
        """The dense sketch: its set's size and a power of two of bits, at least four for each shingle, each shingle flipping one."""
        width = 64 << max(0, (len(s) - 1).bit_length() - 4)
        odd = np.bincount((s >> np.uint64(8)).astype(np.int64) & (width - 1), minlength=width) & 1
        return len(s).to_bytes(8, "little") + np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()

    def within(self, x: tuple[int, np.ndarray], y: tuple[int, np.ndarray]) -> bool:
        """False only if the Hamming distance, which no symmetric difference is below, rules a link out."""
        (n, a), (m, b) = (x, y) if len(x[1]) <= len(y[1]) else (y, x)
        apart = np.bitwise_count(a ^ np.bitwise_xor.reduce(b.reshape(-1, len(a)), axis=0)).sum()
        return int(apart) * (100 + self.percent) <= (100 - self.percent) * (n + m)

    def sketch(self, s: np.ndarray, band: int) -> np.ndarray:
        """Keys of the sketch's words; those without a shingle only if they are over ``slack``."""
        m = int(self.words[band])
        part = (s >> np.uint64(20)) % np.uint64(m)
        if m <= 1 << 16:
            part = part.astype(np.uint16)
        order = np.argsort(part, kind="stable")
        sorted_part = part[order]
        first = np.flatnonzero(np.diff(sorted_part.astype(np.int64), prepend=-1))
        held = sorted_part[first].astype(np.uint64)
        value = np.bitwise_xor.reduceat(mix(s[order] + np.uint64(BASE)), first)
        empty = m - len(held)
        if empty > self.slack[band]:
            bare = np.setdiff1d(np.arange(m, dtype=np.uint64), held, assume_unique=True)
            held, value = np.concatenate([held, bare]), np.concatenate([value, np.zeros(len(bare), np.uint64)])
        key = mix(value ^ mix(held + np.uint64(band << 32) + np.uint64(1)))
        return ((key & np.uint64(0xFFFFFFFFFFFFFF00)) | np.uint64(band)).astype(np.int64)


def _sets(batches: Iterator[pa.RecordBatch], rows: int = 64) -> Iterator[tuple[list, list[np.ndarray], pa.Array]]:
    for batch in slices(batches, rows):
        yield batch.column(0).to_pylist(), [shingles(t) for t in batch.column(1).to_pylist()], batch.column(2)


def _nodes(bands: Bands) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets, th in _sets(batches):
            bare = [[(b, bands.empty(s, b)) for b in bands.of(len(s))] if len(s) else [] for s in sets]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([node_of(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([dict(x) for x in bare], pa.map_(pa.int32(), pa.int32())), th], names=["doc_id", "node", "n", "bare", "th"])

    return run


def _sketch_rows(bands: Bands) -> Callable:
    """(key, node) of each sketch word; a set that the task has seen is not sketched again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for _, sets, _ in _sets(batches):
            keys, nodes = [], []
            for s in sets:
                node = node_of(s)
                if node is None or node in seen:
                    continue
                seen.add(node)
                for band in bands.of(len(s)):
                    k = bands.sketch(s, band)
                    keys.append(k)
                    nodes.append(np.full(len(k), node, np.int64))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(nodes))], names=["key", "node"])

    return run


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, node) to (key, node, size) of groups of two or more; size 0 means more than BUFFER.

    At most BUFFER rows are held back, so a group of any size streams through.
    """

    def rows(k: np.ndarray, v: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(k), pa.array(v), pa.array(n.astype(np.int64))], names=["key", "node", "size"])

    def closed(k: np.ndarray, v: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(k):
            first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
            size = np.diff(first, append=len(k))
            n = np.repeat(size, size)
            if (n > 1).any():
                yield rows(k[n > 1], v[n > 1], n[n > 1])

    tail_k, tail_v, hot = np.zeros(0, np.int64), np.zeros(0, np.int64), None
    for batch in batches:
        k, v = np.concatenate([tail_k, batch.column(0).to_numpy()]), np.concatenate([tail_v, batch.column(1).to_numpy()])
        fresh = np.concatenate([[True], (k[1:] != k[:-1]) | (v[1:] != v[:-1])])[: len(k)]
        k, v = k[fresh], v[fresh]
        tail_k, tail_v = k[:0], v[:0]
        if hot is not None and len(k):
            n = int(np.searchsorted(k, hot[0], "right"))
            more = v[:n][v[:n] != hot[1]]
            if len(more):
                yield rows(np.full(len(more), hot[0]), more, np.zeros(len(more)))
                hot = (hot[0], more[-1])
            k, v = k[n:], v[n:]
        if not len(k):
            continue
        hot = None
        last = int(np.searchsorted(k, k[-1], "left"))
        yield from closed(k[:last], v[:last])
        tail_k, tail_v = k[last:], v[last:]
        if len(tail_k) > BUFFER:
            yield rows(tail_k, tail_v, np.zeros(len(tail_k)))
            hot = (tail_k[0], tail_v[-1])
            tail_k, tail_v = k[:0], v[:0]
    yield from closed(tail_k, tail_v)


def _exact(bands: Bands, mine: np.ndarray, other: np.ndarray) -> bool:
    return bands.linked(len(np.intersect1d(mine, other, assume_unique=True)), len(mine), len(other))


def _meeting(read: Callable, passes: Callable) -> Callable:
    """Rows (a, b, payload) sorted so that a centre's own payload (b null) comes first: the pairs that pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, mine = None, None
        for batch in slices(batches, 64):
            a, b = [], []
            for key, other, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                value = read(payload)
                if other is None:
                    at, mine = key, value
                elif key == at and passes(mine, value):
                    a.append(key)
                    b.append(other)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _met(pairs: DataFrame, payloads: DataFrame, read: Callable, passes: Callable, per_task: int) -> DataFrame:
    """The pairs (a, b) whose payloads pass. A centre with many partners is dealt to several tasks."""
    payloads = payloads.toDF("node", "payload")
    sized = pairs.groupBy("a").agg(F.count("*").alias("c")).select("a", F.ceil(F.col("c") / per_task).cast("int").alias("parts"))
    centres = sized.join(payloads, sized.a == payloads.node).select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"), F.lit(None).cast("long").alias("b"), "payload")
    dealt = pairs.join(sized, "a").select("a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("salt"), "b")
    others = dealt.join(payloads, dealt.b == payloads.node).select("a", "salt", "b", "payload")
    rows = centres.unionByName(others).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first()).select("a", "b", "payload")
    return rows.mapInArrow(_meeting(read, passes), "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame, bands: Bands, per_task: int = 2_000, sketched: bool = False) -> DataFrame:
    """The pairs (a, b) of nodes that link: by Hamming distance of their bit sketches (unless ``sketched``), then by their texts."""
    near = pairs if sketched else materialize(_met(pairs, texts.select("node", "bits"), read_bits, bands.within, 10 * per_task), "ngram-near")
    return _met(near, texts.select("node", "text"), shingles, functools.partial(_exact, bands), per_task)


def _kept(groups: DataFrame, sets: DataFrame, bands: Bands) -> DataFrame:
    """Group rows without the ``slack`` most shared words of each set's sketch (empty words count first)."""
    counted = groups.where("size > 0")
    large = groups.where("size = 0").select("key", "node")
    sizes = large.groupBy("key").agg(F.count("*").alias("size"))
    counted = counted.unionByName(large.join(sizes, "key").select("key", "node", "size"))
    band = F.col("key").bitwiseAND(F.lit(0xFF).cast("long")).cast("int")
    slack = F.element_at(F.array(*(F.lit(int(x)) for x in bands.slack)), F.col("band") + 1)
    bare = sets.where("node is not null").groupBy("node").agg(F.first("bare").alias("bare"))
    order = Window.partitionBy("node", "band").orderBy(F.desc("size"), "key")
    ranked = counted.withColumn("band", band).join(bare, "node").withColumn("at", F.row_number().over(order))
    left = slack - F.least(F.coalesce(F.try_element_at("bare", "band"), F.lit(0)), slack)
    kept = ranked.where(F.col("at") > left).select("key", "node")
    return materialize(kept, "ngram-kept")


def _mixed(members: DataFrame, comps: DataFrame) -> DataFrame:
    """``node, component`` of the members of groups that hold several components."""
    named = members.join(comps, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    keys = named.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
    return materialize(named.join(keys, "key", "left_semi").groupBy("node").agg(F.first("component").alias("component")), "ngram-mixed")


def _stars(members: DataFrame, centres: int = 3) -> DataFrame:
    """Each node with those of its groups' smallest nodes that it meets in most groups, ``centres`` of them at most.

    This only joins what is plainly alike; the pairs left out meet in ``_crossing``.
    """
    centre = members.groupBy("key").agg(F.min("node").alias("a"))
    met = members.join(centre, "key").where("node <> a").groupBy("a", F.col("node").alias("b")).agg(F.count("*").alias("words"))
    best = F.row_number().over(Window.partitionBy("b").orderBy(F.desc("words"), "a"))
    return met.withColumn("at", best).where(F.col("at") <= centres).select("a", "b")


def _texts(bands: Bands) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            bits = [bands.bits(shingles(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bits, pa.binary())], names=["node", "text", "bits"])

    return run


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 64):
        for node, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            s = shingles(text).astype(np.int64)
            same = lambda x: pa.array(np.full(len(s), x, np.int64))  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays([same(node), same(len(s)), pa.array(s)], names=["node", "n", "shingle"])


def _placed(mixed: DataFrame, texts: DataFrame, percent: int, per_tile: int) -> DataFrame:
    """``shingle, node, n, most, mp, qp``: the shingles at which a set may meet a partner, the largest size of one, and
    in how many parts of ``per_tile`` sets the shingle's smaller and larger sides are cut.

    A set's shingles stand in one order for all sets, those that fewest of the
    sets hold first. The first shingle that two linked sets share has at least
    their common count at or after it in both; from its place in each set
    follows the largest size of a partner there.
    """
    rows = mixed.join(texts.select("node", "text"), "node").select("node", "text").mapInArrow(_shingle_rows, "node long, n long, shingle long")
    held = rows.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    each = Window.partitionBy("node")
    placed = (
        rows.join(held, "shingle")
        .withColumn("left", F.lit(1) - F.row_number().over(each.orderBy("df", "shingle")) + F.count("*").over(each))
        .where(F.col("left") * 100 >= F.col("n") * percent)
        .withColumn("most", F.floor(F.col("left") * (100 + percent) / F.lit(percent)) - F.col("n"))
    )
    placed = materialize(placed.select("shingle", "node", "n", "most"), "ngram-placed")
    cut = lambda c: F.ceil(c / per_tile).cast("int")
    large = placed.groupBy("shingle").agg(cut(F.count_if(F.col("most") >= F.col("n"))).alias("mp"), cut(F.count("*")).alias("qp")).where("qp > 1")
    out = placed.join(large, "shingle", "left").withColumns({c: F.greatest(F.coalesce(c, F.lit(1)), F.lit(1)) for c in ("mp", "qp")})
    out._scratch_path = placed._scratch_path
    return out


def _differences(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Hamming distances of pairs of sketches, the longer one of each folded to the other's length."""
    out = np.zeros(len(x), np.int64)
    lengths = np.array([(min(len(a), len(b))) for a, b in zip(x, y, strict=True)])
    for m in np.unique(lengths):
        at = np.flatnonzero(lengths == m)
        step = max(1, (1 << 20) // int(m))
        for k in range(0, len(at), step):
            own = at[k : k + step]
            folded = [np.stack([v if len(v) == m else np.bitwise_xor.reduce(v.reshape(-1, m), axis=0) for v in (side[i] for i in own)]) for side in (x, y)]
            out[own] = np.bitwise_count(folded[0] ^ folded[1]).sum(1)
    return out


def _near(percent: int, best: bool) -> Callable:
    """Tiles of rows, index side first, to pairs (a, b, far) of different components that places and sketches leave.

    ``best`` keeps each probe's nearest only. Nothing else of a tile is given out.
    """
    kinds = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("far", pa.float64())])

    def compare(members: list, probes: list) -> pa.RecordBatch | None:
        if not members or not probes:
            return None
        node, comp, n, most = (np.array([r[i] for r in members], np.int64) for i in (5, 6, 7, 8))
        q_node, q_comp, q_n, q_most = (np.array([r[i] for r in probes], np.int64) for i in (5, 6, 7, 8))
        open_ = (comp != q_comp[:, None]) & (n <= q_n[:, None]) & (q_n[:, None] <= most) & (n <= q_most[:, None])
        open_ &= (n < q_n[:, None]) | (node < q_node[:, None])
        q, m = np.nonzero(open_)
        if not len(q):
            return None
        sketch = {r[5]: read_bits(r[9])[1] for rows in (members, probes) for r in rows}
        both = n[m] + q_n[q]
        apart = _differences([sketch[i] for i in node[m].tolist()], [sketch[i] for i in q_node[q].tolist()])
        near = apart * (100 + percent) <= (100 - percent) * both
        q, m, far = q[near], m[near], (apart / both)[near]
        if best and len(q):
            order = np.lexsort((node[m], far, q))
            q, m, far = q[order], m[order], far[order]
            first = np.flatnonzero(np.diff(q, prepend=-1))
            q, m, far = q[first], m[first], far[first]
        return pa.RecordBatch.from_arrays([pa.array(node[m]), pa.array(q_node[q]), pa.array(far)], schema=kinds) if len(q) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, members, probes = None, [], []
        for batch in slices(batches, 1024):
            # shingle, i, j, probe, (unused), node, component, n, most, bits
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if r[:3] != tile or len(probes) * len(members) >= 1 << 22:
                    out = compare(members, probes)
                    if out is not None:
                        yield out
                    tile, members, probes = r[:3], members if r[:3] == tile else [], []
                (probes if r[3] else members).append(r)
        out = compare(members, probes)
        if out is not None:
            yield out

    return run


def _crossing(placed: DataFrame, mixed: DataFrame, texts: DataFrame, percent: int, best: bool) -> DataFrame:
    """Pairs (a, b) of ``mixed`` (node, component) in different components that may still link.

    Sets that meet at a shingle too late for either one's size are no pair, and a
    copy with many words of its own meets nobody; other pairs are compared by the
    Hamming distance of their bit sketches where they meet, inside a task. Only
    what may link comes out: for ``best`` one pair a set, else all. Shingles of
    many sets are dealt to tiles, each of a part of either side.
    """
    rows = placed.join(mixed, "node").join(texts.select("node", "bits"), "node")
    own = lambda parts: F.pmod(F.xxhash64("node"), parts).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    columns = ["shingle", "i", "j", "probe", F.lit(0).alias("unused"), "node", "component", "n", "most", "bits"]
    index = rows.where("most >= n").withColumn("i", own("mp")).withColumn("j", every("qp")).withColumn("probe", F.lit(False)).select(*columns)
    probe = rows.withColumn("j", own("qp")).withColumn("i", every("mp")).withColumn("probe", F.lit(True)).select(*columns)
    tiles = index.unionByName(probe).repartition("shingle", "i", "j").sortWithinPartitions("shingle", "i", "j", "probe")
    found = tiles.mapInArrow(_near(percent, best), "a long, b long, far double")
    if best:
        found = found.groupBy("b").agg(F.min_by("a", F.struct("far", "a")).alias("a"))
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _release(spark) -> None:
    """Let Spark's cleaner drop shuffle files of plans that are done."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _named(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("th", F.xxhash64("text"))


def document_sets(docs: DataFrame, bands: Bands) -> DataFrame:
    """Per row: ``doc_id``; hash of the set (``node``, null if empty) and its size; empty sketch words by band; hash of the text.

    Written to the shared folder.
    """
    return materialize(_named(docs).mapInArrow(_nodes(bands), "doc_id long, node long, n long, bare map<int,int>, th long"), "ngram-nodes")


def set_links(docs: DataFrame, sets: DataFrame, bands: Bands, per_tile: int = 1 << 10) -> DataFrame:
    """``node, component`` for every set that links with another."""
    spark = docs.sparkSession
    named = _named(docs)
    keyed = named.mapInArrow(_sketch_rows(bands), "key long, node long")
    groups = materialize(keyed.repartition("key").sortWithinPartitions("key", "node").mapInArrow(_grouped, "key long, node long, size long"), "ngram-groups")
    _release(spark)
    kept = _kept(groups, sets, bands)
    discard(groups)
    # one text for each set that has a candidate
    needed = kept.select("node").distinct()
    first = sets.where("node is not null").groupBy("node").agg(F.min(F.struct("doc_id", "th")).alias("f"))
    wanted = first.join(needed, "node", "left_semi").select("node", F.col("f.doc_id").alias("first_id"), F.col("f.th").alias("first_th"))
    found = named.join(wanted, named.doc_id.eqNullSafe(F.col("first_id")) & (named.th == F.col("first_th")))
    texts = materialize(found.select("node", "text").dropDuplicates(["node"]).mapInArrow(_texts(bands), "node long, text string, bits binary"), "ngram-texts")
    _release(spark)
    links = materialize(verified(_stars(kept), texts, bands), "ngram-links")
    comps = components(links, "ngram-components")
    mixed = _mixed(kept, comps)
    if not is_empty(mixed):
        placed = _placed(mixed, texts, bands.percent, per_tile)
        for best in (True, False):  # each set's nearest first: what they join needs no other look
            named = mixed.select("node").join(comps, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
            pairs = materialize(_crossing(placed, named, texts, bands.percent, best), "ngram-pairs")
            more = materialize(links.unionByName(verified(pairs, texts, bands, sketched=True)), "ngram-links")
            discard(links, pairs)
            links = more
            comps = components(links, "ngram-components")
        discard(placed)
    discard(kept, texts, links, mixed)
    return comps


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id`` (the smallest id reachable by links)."""
    bands = Bands(percent)
    sets = document_sets(docs, bands)
    comps = set_links(docs, sets, bands)
    classed = join_spread(sets.select("doc_id", "n", "node"), comps, "node", "doc_id").select("doc_id", "n", F.coalesce("component", "node").alias("class"))
    least = classed.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("component_id"))
    return join_spread(classed, least, "class", "doc_id").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One row, with all its columns, of each component: the one with the smallest id (no id comes last), then the
    smallest text hash. Rows that repeat both are one row. Empty sets link with nothing, so their rows all stay.
    """
    bands = Bands(percent)
    sets = document_sets(docs, bands)
    comps = set_links(docs, sets, bands)
    classed = join_spread(sets.select("doc_id", "th", "node"), comps, "node", "doc_id").select("doc_id", "th", F.coalesce("component", "node").alias("class"))
    named = classed.where("class is not null").groupBy("class", "doc_id", "th").agg(F.count("*").alias("rows"))
    best = named.groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull().alias("bare"), "doc_id", "th", "rows")).alias("k")).select(F.col("k.doc_id").alias("_id"), F.col("k.th").alias("_th"), F.col("k.rows").alias("_rows"))
    bare = classed.where("class is null").select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), F.lit(1).cast("long").alias("_rows")).distinct()
    chosen = materialize(best.unionByName(bare), "ngram-chosen")
    keyed = docs.withColumn("_key", F.struct(F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.col("text").cast("string")).alias("th")))
    kept = keyed.join(chosen, F.col("_key.id").eqNullSafe(F.col("_id")) & (F.col("_key.th") == F.col("_th")))
    once = kept.where("_rows = 1").select(docs.columns)
    return once.unionByName(kept.where("_rows > 1").dropDuplicates(["_key"]).select(docs.columns))


#: The same rows in DuckDB by brute force, for documents whose ids are all different.
SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i : array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1
), p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), e AS (SELECT x, y FROM p JOIN n a ON x = a.doc_id JOIN n b ON y = b.doc_id WHERE 100 * c >= 80 * (a.n + b.n - c)
), links AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e
), r(doc_id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.y, r.root FROM r JOIN links l ON l.x = r.doc_id)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(root) AS component_id FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""
