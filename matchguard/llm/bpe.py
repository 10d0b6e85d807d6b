"""Byte-level BPE encoding and decoding on length-bucketed padded matrices.

Pre-tokens (matches of the split pattern) of a batch are laid into integer
matrices, one for each power-of-two length, padded with -1. Each round every
row merges its leftmost pair of minimum rank, found through a hashed table of
token pairs, then closes the gap; rows without a pair left leave the matrix.
That takes time with the square of a pre-token's length, so the rare one of more
than ``LONG`` bytes merges its pairs in the same order from a heap instead.

A text is cut at each space that follows a non-space; matches never span such a
cut, so the ids of a chunk are kept in the worker's cache and new chunks of a
batch are encoded together.

Defined results: texts of any length are encoded whole in one task, in time in
proportion to their length, for unbroken runs of letters times its logarithm; a
null or empty text has no ids and decodes to no bytes; ids
out of the vocabulary raise ``ValueError``; rows that repeat are encoded each;
an empty table gives an empty result; other columns stay unless stated.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, strings

LONG = 4096
NONE = np.int32(2**31 - 1)
#: A space before white space or the end.
_ODD = re.compile(r" (?:\s|\Z)")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class PairTable:
    """Open addressing over numpy arrays: (left id, right id) -> id of the joined token."""

    def __init__(self, left: np.ndarray, right: np.ndarray, joined: np.ndarray):
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 2.5))))
        self.keys = np.full(1 << self.bits, np.iinfo(np.uint64).max, np.uint64)
        self.values = np.full(1 << self.bits, NONE, np.int32)
        slot, rest = self._slot(keys), np.arange(len(keys))
        while len(rest):
            at = slot[rest]
            free = self.keys[at] == np.iinfo(np.uint64).max
            first = np.unique(at[free], return_index=True)[1]
            take = rest[free][first]
            self.keys[slot[take]], self.values[slot[take]] = keys[take], joined[take]
            rest = np.setdiff1d(rest, take, assume_unique=True)
            slot[rest] = slot[rest] + 1 & (1 << self.bits) - 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * _MIX >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Joined ids, NONE where the pair has none or either side is padding."""
        shape = left.shape
        left, right = left.ravel(), right.ravel()
        out = np.full(left.shape, NONE, np.int32)
        rest = np.flatnonzero((left >= 0) & (right >= 0))
        keys = left[rest].astype(np.uint64) << np.uint64(32) | right[rest].astype(np.uint64)
        slot = self._slot(keys)
        while len(rest):
            held = self.keys[slot]
            hit = held == keys
            out[rest[hit]] = self.values[slot[hit]]
            on = ~hit & (held != np.iinfo(np.uint64).max)
            rest, keys, slot = rest[on], keys[on], slot[on] + 1 & (1 << self.bits) - 1
        return out.reshape(shape)


class ByteBPE:
    """Codec over tiktoken ranks; equal to that library's ``encode_ordinary``.

    The pattern must part letters from other signs, as the public one does.
    """

    #: No apostrophe: it begins suffixes.
    MARKS = ".,!?;:*#$%&+-/=@^_~()[]{}<>|\"\\`"

    def __init__(self, ranks_path: str, pattern: str, limit: int = 600_000):
        import regex

        self.ranks = read_ranks(ranks_path)
        self.findall = regex.compile(pattern).findall
        self.limit, self.cache = limit, {"": b""}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.byte_id = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [(self.ranks[t[:i]], self.ranks[t[i:]], r) for t, r in self.ranks.items() for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        table = np.array(pairs, np.int64).reshape(-1, 3)
        self.joined = {a << 32 | b: r for a, b, r in pairs}
        self.pairs = PairTable(table[:, 0], table[:, 1], table[:, 2].astype(np.int32))

    def merge(self, ids: np.ndarray) -> np.ndarray:
        """Merge padded rows to their end; rows come back in order, padded with -1."""
        out = ids.copy()
        rows = np.arange(len(ids))
        rank = self.pairs.find(ids[:, :-1], ids[:, 1:])
        while len(rows) and ids.shape[1] > 1:
            at = rank.argmin(axis=1)  # the leftmost of equal ranks
            best = np.take_along_axis(rank, at[:, None], 1)[:, 0]
            on = best != NONE
            if not on.all():  # done rows leave
                out[rows[~on]] = -1
                out[rows[~on], : ids.shape[1]] = ids[~on]
                rows, ids, rank, at, best = rows[on], ids[on], rank[on], at[on], best[on]
                if not len(rows):
                    break
            k = np.arange(len(rows))
            width = ids.shape[1]
            cols = np.arange(width - 1)
            ids[k, at] = best
            ids = np.take_along_axis(ids, cols + (cols > at[:, None]), 1)
            if width == 2:
                rank = np.full((len(rows), 1), NONE, np.int32)
                ids = np.concatenate([ids, np.full((len(rows), 1), -1, np.int32)], axis=1)
                continue
            cols = cols[:-1]
            rank = np.take_along_axis(rank, cols + (cols >= at[:, None]), 1)
            # the new token changed the pair on either side of it
            left, right = at > 0, at < width - 2
            rank[k[left], at[left] - 1] = self.pairs.find(ids[k[left], at[left] - 1], ids[k[left], at[left]])
            rank[k[right], at[right]] = self.pairs.find(ids[k[right], at[right]], ids[k[right], at[right] + 1])
        return out

    def merge_long(self, word: bytes) -> bytes:
        """The same merges for one long pre-token: a heap of (rank, place) over a linked list."""
        ids, n, get = self.byte_id[np.frombuffer(word, np.uint8)].tolist(), len(word), self.joined.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or get(ids[i] << 32 | ids[j]) != rank:
                continue  # merged otherwise since
            ids[i], ids[j], after[i] = rank, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (r := get(ids[k] << 32 | ids[after[k]])) is not None:
                    heapq.heappush(heap, (r, k))
        done = np.array(ids, "<i4")
        return done[done >= 0].tobytes()

    def encode_words(self, words: list[bytes], cells: int = 1 << 20) -> list[bytes]:
        """Ids of separate pre-tokens as little-endian 32-bit numbers; at most ``cells`` matrix cells at a time."""
        out: list[bytes] = [b""] * len(words)
        buckets: dict[int, list[int]] = {}
        whole = self.ranks.get
        for i, w in enumerate(words):
            rank = whole(w)
            if rank is not None:
                out[i] = rank.to_bytes(4, "little")
            elif len(w) > LONG:
                out[i] = self.merge_long(w)
            elif w:
                buckets.setdefault(max(2, 1 << (len(w) - 1).bit_length()), []).append(i)
        for width, members in buckets.items():
            step = max(1, cells // width)
            for a in range(0, len(members), step):
                part = members[a : a + step]
                sizes = np.array([len(words[i]) for i in part])
                ids = np.full((len(part), width), -1, np.int32)
                ids[np.arange(width) < sizes[:, None]] = self.byte_id[np.frombuffer(b"".join([words[i] for i in part]), np.uint8)]
                done = self.merge(ids)
                ends = np.cumsum((done >= 0).sum(axis=1)) * 4
                data, cuts = done[done >= 0].astype("<i4").tobytes(), [0, *ends.tolist()]
                for i, x, y in zip(part, cuts[:-1], cuts[1:], strict=True):
                    out[i] = data[x:y]
        return out

    @staticmethod
    def chunks(text: str) -> list[str]:
        """Cut before each space that follows a non-space and stands before one."""
        parts = text.split(" ")
        tail = [" " + p for p in parts[1:]]
        if not _ODD.search(text):
            return parts[:1] + tail
        joined = parts[:1]
        for p in tail:  # white-space runs stay whole
            before = joined[-1][-1:]
            if (p == " " or p[1].isspace()) and (not before or before.isspace()):
                joined[-1] += p
            else:
                joined.append(p)
        return joined

    def _learn(self, new: list[str]) -> None:
        """Cache new chunks; a word and the marks that end it need no pattern search."""
        cache, found, words = self.cache, {}, set()
        for c in new:
            if c[1:].isalpha() and (c[0] == " " or c[0].isalpha()):
                words.add(c)
                continue
            stem = c.rstrip(self.MARKS)
            if stem != c and stem[1:].isalpha() and (stem[0] == " " or stem[0].isalpha()):
                found[c] = (stem, c[len(stem) :])
            else:
                found[c] = self.findall(c)
            words.update(found[c])
        fresh = [w for w in words if w not in cache]
        cache.update(zip(fresh, self.encode_words([w.encode() for w in fresh]), strict=True))
        for c, f in found.items():
            cache[c] = b"".join([cache[w] for w in f])

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        split = [self.chunks(t) for t in texts]
        if len(self.cache) > self.limit:
            self.cache = {"": b""}
        cache = self.cache
        new = [c for c in set().union(*split) if c not in cache] if split else []
        if new:
            self._learn(new)
        get = cache.__getitem__
        return [np.frombuffer(b"".join(map(get, c)), np.int32) for c in split]

    def decode(self, ids: np.ndarray) -> bytes:
        try:
            return b"".join(map(self.tokens.__getitem__, ids.tolist()))
        except KeyError as e:
            raise ValueError(f"no such id: {e}") from None


_CODECS: dict[tuple[str, str], ByteBPE] = {}


def codec(path: str, pattern: str) -> ByteBPE:
    """One codec for each Python worker."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = ByteBPE(path, pattern)
    return _CODECS[path, pattern]


def _named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``doc_id, ids array<int>``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for batch in slices(batches):
            ids = bpe.encode_batch(strings(batch.column(1)))
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["doc_id", "ids"])

    return _named(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per row of :func:`encode_documents`: ``doc_id, bytes binary``; null ids decode to no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for batch in slices(batches):
            data = [bpe.decode(np.array(x or [], np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], names=["doc_id", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary")


def _digests(bpe: ByteBPE, texts: list[str]) -> tuple[list[int], list[str], list[str]]:
    counts, of_ids, of_bytes = [], [], []
    for ids in bpe.encode_batch(texts):
        counts.append(len(ids))
        of_ids.append(hashlib.sha256(" ".join(map(str, ids.tolist())).encode()).hexdigest())
        of_bytes.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
    return counts, of_ids, of_bytes


def round_trip_digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, decode what was encoded, and digest both in one pass over the texts.

    Per document: ``doc_id, n_tokens, ids_sha256`` (of the decimal ids joined by
    one space) and ``decoded_sha256`` (of the decoded bytes).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for batch in slices(batches):
            counts, of_ids, of_bytes = _digests(bpe, strings(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _named(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


