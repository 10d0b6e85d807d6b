"""Token-ID output as sorted-string-table shards.

A shard holds documents in ascending key order::

    magic | block ... block | index | bloom | footer | magic

* key: one byte 0 for a null id, or one byte 1 and the id as a big-endian
  unsigned number with its sign bit turned, so byte order is id order;
* block: entries ``shared, unshared, value length`` (varints), key suffix,
  value; every 16th entry is a restart point with its whole key; the restart
  offsets and their count end the block; the block is stored with zstd and a
  crc32;
* index: first key, offset and size of every block (sparse: one per block);
* bloom: a Bloom filter over the keys of the shard;
* footer: fixed-size offsets and counts.

A value is the ids as little-endian unsigned 16- or 32-bit numbers (the footer
says which). A lookup reads footer, Bloom filter and index, binary-searches the
index, reads one block and binary-searches its restart points.

Defined results: a null text is an empty document, so it holds only the end id;
a null id sorts first; rows that repeat an id are all kept, ordered by their
text's hash; a text of any length is one entry, encoded whole in one task; an
empty table gives no shards; other columns are not stored.
"""

from __future__ import annotations

import bisect
import hashlib
import io
import itertools
import json
import os
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, strings

MAGIC = b"MGSST001"
FOOTER = struct.Struct("<QQQQQQBB")  # index at, size, bloom at, size, entries, ids, bytes an id, Bloom probes
RESTART = 16
MANIFEST_SCHEMA = "shard int, path string, n_docs long, n_tokens long, first_id long, last_id long"


def key_of(doc_id: int | None) -> bytes:
    return b"\0" if doc_id is None else b"\1" + struct.pack(">Q", doc_id + (1 << 63))


def id_of(key: bytes) -> int | None:
    return None if key == b"\0" else struct.unpack(">Q", key[1:])[0] - (1 << 63)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        at += 1
        n |= (b & 127) << shift
        if b < 128:
            return n, at
        shift += 7


def _probes(key: bytes, bits: int, k: int) -> list[int]:
    a, b = struct.unpack("<QQ", hashlib.blake2b(key, digest_size=16).digest())
    return [(a + i * (b | 1)) % bits for i in range(k)]


class SSTableWriter:
    """Writes entries, given in ascending key order, to a binary stream."""

    def __init__(self, out, id_bytes: int, block_bytes: int = 64 << 10, bloom_bits: int = 10):
        self.out, self.id_bytes, self.block_bytes, self.bloom_bits = out, id_bytes, block_bytes, bloom_bits
        self.at = self.entries = self.ids = 0
        self.index: list[tuple[bytes, int, int]] = []
        self.keys: list[bytes] = []
        self.pack = zstandard.ZstdCompressor(level=3)
        self._write(MAGIC)
        self._open()

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def _open(self) -> None:
        self.block, self.restarts, self.n, self.last, self.first = bytearray(), [], 0, b"", b""

    def add(self, key: bytes, value: bytes) -> None:
        if self.n % RESTART == 0:
            self.restarts.append(len(self.block))
            shared = 0
        else:
            shared = len(os.path.commonprefix((self.last, key)))
        if not self.n:
            self.first = key
        self.block += _varint(shared) + _varint(len(key) - shared) + _varint(len(value)) + key[shared:] + value
        self.last, self.n = key, self.n + 1
        if not self.keys or self.keys[-1] != key:
            self.keys.append(key)
        self.entries += 1
        self.ids += len(value) // self.id_bytes
        if len(self.block) >= self.block_bytes:
            self._close_block()

    def _close_block(self) -> None:
        if self.n:
            raw = bytes(self.block) + struct.pack(f"<{len(self.restarts)}II", *self.restarts, len(self.restarts))
            data = self.pack.compress(raw)
            data = struct.pack("<I", zlib.crc32(data)) + data
            self.index.append((self.first, self.at, len(data)))
            self._write(data)
        self._open()

    def close(self) -> None:
        self._close_block()
        index_at = self.at
        self._write(b"".join(_varint(len(k)) + k + _varint(o) + _varint(s) for k, o, s in self.index))
        bloom_at = self.at
        k = max(1, round(self.bloom_bits * 0.69))
        bits = np.zeros(max(64, len(self.keys) * self.bloom_bits + 7 & ~7), np.uint8)
        for key in self.keys:
            bits[_probes(key, len(bits), k)] = 1
        self._write(np.packbits(bits, bitorder="little").tobytes())
        self._write(FOOTER.pack(index_at, bloom_at - index_at, bloom_at, self.at - bloom_at, self.entries, self.ids, self.id_bytes, k))
        self._write(MAGIC)


class SSTableReader:
    """Reads a shard from a seekable binary stream, block by block."""

    def __init__(self, stream):
        self.f = stream
        stream.seek(0, io.SEEK_END)
        end = stream.tell()
        tail = FOOTER.size + len(MAGIC)
        if end < tail + len(MAGIC):
            raise ValueError("not a table: too short")
        foot = self._at(end - tail, tail)
        if foot[-len(MAGIC) :] != MAGIC:
            raise ValueError("not a table: wrong magic")
        index_at, index_size, bloom_at, bloom_size, self.entries, self.ids, self.id_bytes, self.k = FOOTER.unpack(foot[: FOOTER.size])
        self.bloom = np.unpackbits(np.frombuffer(self._at(bloom_at, bloom_size), np.uint8), bitorder="little")
        raw, at, self.index = self._at(index_at, index_size), 0, []
        while at < len(raw):
            n, at = _read_varint(raw, at)
            key, at = raw[at : at + n], at + n
            offset, at = _read_varint(raw, at)
            size, at = _read_varint(raw, at)
            self.index.append((key, offset, size))
        self.firsts = [x[0] for x in self.index]

    def _at(self, offset: int, size: int) -> bytes:
        self.f.seek(offset)
        return self.f.read(size)

    def _block(self, i: int) -> tuple[bytes, list[int]]:
        _, offset, size = self.index[i]
        data = self._at(offset, size)
        if zlib.crc32(data[4:]) != struct.unpack("<I", data[:4])[0]:
            raise ValueError(f"block {i} is damaged")
        raw = zstandard.ZstdDecompressor().decompress(data[4:])
        n = struct.unpack("<I", raw[-4:])[0]
        return raw[: -4 - 4 * n], list(struct.unpack(f"<{n}I", raw[-4 - 4 * n : -4]))

    @staticmethod
    def _entries(raw: bytes, at: int = 0) -> Iterator[tuple[bytes, bytes]]:
        key = b""
        while at < len(raw):
            shared, at = _read_varint(raw, at)
            unshared, at = _read_varint(raw, at)
            size, at = _read_varint(raw, at)
            key = key[:shared] + raw[at : at + unshared]
            at += unshared
            yield key, raw[at : at + size]
            at += size

    def __iter__(self) -> Iterator[tuple[bytes, bytes]]:
        for i in range(len(self.index)):
            yield from self._entries(self._block(i)[0])

    def may_hold(self, key: bytes) -> bool:
        return bool(self.bloom[_probes(key, len(self.bloom), self.k)].all())

    def get(self, key: bytes) -> list[bytes]:
        """The values stored under ``key``: none, one, or one for each repeated row."""
        if not self.index or not self.may_hold(key):
            return []
        found: list[bytes] = []
        # the key may begin in the block before the first one that starts with it
        i = max(0, bisect.bisect_left(self.firsts, key) - 1)
        while i < len(self.index) and self.firsts[i] <= key:
            raw, restarts = self._block(i)
            lo, hi = 0, len(restarts) - 1
            while lo < hi:  # the last restart point with a smaller key
                mid = (lo + hi + 1) // 2
                if next(self._entries(raw, restarts[mid]))[0] < key:
                    lo = mid
                else:
                    hi = mid - 1
            for k, v in self._entries(raw, restarts[lo]):
                if k > key:
                    return found
                if k == key:
                    found.append(v)
            i += 1
        return found


class ChunkEncoder:
    """Ids of texts by the tokenizers library, through a cache of white-space chunks.

    The tokenizer's own rules drop white space and never join what a space or a
    line end parts, so a text's ids are those of its chunks in a row. Marks that
    end a chunk are a token run of their own, so new chunks go to the library
    without them, in one batch. As the rules lower case anyway, Latin-1 texts
    (where that is plain for each character) are lowered first, which saves
    chunks. The cache starts anew at ``limit``.
    """

    #: No apostrophe (it begins suffixes) and no sign of the special tokens' names.
    MARKS = ".,!?;:*#$%&+-/=@^_~()[]{}\"\\`"

    def __init__(self, path: str, limit: int = 800_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.limit, self.cache = Tokenizer.from_file(path), limit, {"": b""}
        self.id_bytes = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = f"<u{self.id_bytes}"
        rules = json.loads(self.tokenizer.to_str())
        steps = (rules.get("normalizer") or {}).get("normalizers", [])
        suffix = (rules.get("model") or {}).get("end_of_word_suffix") or None
        self.closes = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.closes[i] = bool(suffix) and token.endswith(suffix)
        self.bare = Tokenizer(self.tokenizer.model)
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        signs = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.signs = {i: signs.pre_tokenize_str(chr(i))[0][0] for i in range(33, 256) if chr(i).isalpha()}
        self.lowers = any(x.get("type") == "Lowercase" for x in steps)
        self.parts = any(x.get("type") == "Replace" and x.get("pattern") == {"Regex": "\\s+"} for x in steps) and (rules.get("pre_tokenizer") or {}).get("type") == "Sequence"

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.kind).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of lower-case Latin-1 words of letters only, which the rules leave as they are.

        Their bytes are mapped as the rules map them, then long lines of words go
        through the library's model and are cut where a word's last token ends.
        """
        out: list[bytes] = []
        lines = [words[a : a + 512] for a in range(0, len(words), 512)]
        for line, e in zip(lines, self.bare.encode_batch_fast([" ".join(x).translate(self.signs) for x in lines], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, np.int64)
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) != len(line):
                out += self._library(line)
                continue
            data, cuts = ids.astype(self.kind).tobytes(), [0, *(ends * self.id_bytes).tolist()]
            out += [data[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return out

    def _chunks(self, text: str) -> list[str]:
        if self.lowers:
            try:
                text.encode("latin-1")
                text = text.lower()
            except UnicodeEncodeError:
                pass
        return text.replace("\n", " ").split(" ")

    def _as_is(self, word: str) -> bool:
        if word.isascii():
            return self.lowers and word.islower()
        try:
            word.encode("latin-1")
        except UnicodeEncodeError:
            return False
        return self.lowers and word == word.lower()

    def _learn(self, new: list[str]) -> None:
        cache, stems, cut = self.cache, set(), {}
        for w in new:
            stem = w.rstrip(self.MARKS)
            # only after a letter of an old alphabet that stays one in lower case (capital dotted I does not)
            if stem == w or not (stem[-1:] < "\u0530" and stem[-1:].lower()[-1:].isalpha()):
                stems.add(w)
            else:
                cut[w] = stem
                stems.update((stem, w[len(stem) :]))
        fresh = [w for w in stems if w not in cache]
        plain, other = [], []
        for w in fresh:
            (plain if w.isalpha() and self._as_is(w) else other).append(w)
        cache.update(zip(plain, self._words(plain), strict=True))
        cache.update(zip(other, self._library(other), strict=True))
        cache.update((w, cache[stem] + cache[w[len(stem) :]]) for w, stem in cut.items())

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.parts:  # another kind of tokenizer: no assumption about chunks
            return self._library(texts)
        split = [self._chunks(t) for t in texts]
        if len(self.cache) > self.limit:
            self.cache = {"": b""}
        cache = self.cache
        new = [w for w in set().union(*split) if w not in cache] if split else []
        if new:
            self._learn(new)
        get = cache.__getitem__
        return [b"".join(map(get, words)) for words in split]


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """One encoder for each Python worker and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def _fs(uri: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in uri and not uri.startswith("file:"):
        uri = "file://" + os.path.abspath(uri)
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return pafs.FileSystem.from_uri(uri)


def _writer(uri: str, tokenizer: str, end_id: int) -> Callable:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        fs, root = _fs(uri)
        coder, table, sink, first, last = encoder(tokenizer), None, None, None, None
        end = np.array([end_id], coder.kind).tobytes()
        tmp, path = f"{root}/.shard-{shard:06d}-{uuid.uuid4().hex[:8]}.tmp", f"{root}/shard-{shard:06d}.sst"
        for batch in slices(batches, 128):
            if table is None:
                sink = fs.open_output_stream(tmp)
                table = SSTableWriter(sink, coder.id_bytes)
                first = batch.column(0)[0].as_py()
            last = batch.column(0)[batch.num_rows - 1].as_py()
            for doc_id, ids in zip(batch.column(0).to_pylist(), coder.encode(strings(batch.column(1))), strict=True):
                table.add(key_of(doc_id), ids + end)
        if table is not None:
            table.close()
            sink.close()
            fs.move(tmp, path)  # a second attempt of the task writes the same bytes
            yield pa.RecordBatch.from_pylist([{"shard": shard, "path": f"{uri}/shard-{shard:06d}.sst", "n_docs": table.entries, "n_tokens": table.ids, "first_id": first, "last_id": last}], schema=pa.schema([("shard", pa.int32()), ("path", pa.string()), *((c, pa.int64()) for c in ("n_docs", "n_tokens", "first_id", "last_id"))]))

    return write


def write_sstables(docs: DataFrame, uri: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", shards: int | None = None) -> list[dict]:
    """Encode every text and write sorted shards under ``uri``; returns the manifest.

    One range shuffle on (id, hash of the text) deals the documents: the hash
    splits the rows of an id that repeats often. ``shards`` sets how many there
    are (by default ``spark.sql.shuffle.partitions``): take the input's size over
    the shard size that readers want, some 256 MB. The manifest, one small row a
    shard with its first and last id, is also written to ``uri/MANIFEST.json``.
    """
    fs, root = _fs(uri)
    fs.create_dir(root, recursive=True)
    keyed = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), F.xxhash64(text_col).alias("h"))
    dealt = (keyed.repartitionByRange(shards, "id", "h") if shards else keyed.repartitionByRange("id", "h")).sortWithinPartitions("id", "h").select("id", "text")
    rows = dealt.mapInArrow(_writer(uri, tokenizer, end_id), MANIFEST_SCHEMA).collect()
    start, manifest = 0, []
    for r in sorted(rows, key=lambda r: r["shard"]):
        manifest.append(r.asDict() | {"start": start})
        start += r["n_tokens"]
    with fs.open_output_stream(f"{root}/MANIFEST.json") as out:
        out.write(json.dumps(manifest).encode())
    return manifest


def manifest_of(uri: str) -> list[dict]:
    fs, root = _fs(uri)
    with fs.open_input_stream(f"{root}/MANIFEST.json") as f:
        return json.loads(f.read())


def open_shard(path: str) -> SSTableReader:
    fs, p = _fs(path)
    return SSTableReader(fs.open_input_file(p))


def lookup(uri: str, doc_id: int | None) -> list[np.ndarray]:
    """Ids of one document: the manifest's key ranges name the shards, whose Bloom filters are asked before a block is read."""
    out, manifest = [], manifest_of(uri)
    order = (-1, 0) if doc_id is None else (0, doc_id)
    rank = lambda v: (-1, 0) if v is None else (0, v)
    at = bisect.bisect_left(manifest, order, key=lambda m: rank(m["last_id"]))
    for entry in itertools.takewhile(lambda m: rank(m["first_id"]) <= order, manifest[at:]):
        table = open_shard(entry["path"])
        out += [np.frombuffer(v, f"<u{table.id_bytes}") for v in table.get(key_of(doc_id))]
    return out


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.list_(pa.int32()))])
    for batch in batches:
        for row in batch.to_pylist():
            table, at = open_shard(row["path"]), row["start"]
            ids, starts, values, held = [], [], [], 0
            for key, value in table:
                v = np.frombuffer(value, f"<u{table.id_bytes}").astype(np.int32)
                ids.append(id_of(key))
                starts.append(at)
                values.append(v)
                at, held = at + len(v), held + len(v)
                if held >= 1 << 19:
                    yield _rows(schema, ids, starts, values)
                    ids, starts, values, held = [], [], [], 0
            if ids:
                yield _rows(schema, ids, starts, values)


def _rows(schema: pa.Schema, ids: list, starts: list, values: list[np.ndarray]) -> pa.RecordBatch:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(starts, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values)))], schema=schema)


def shards_of(spark: SparkSession, manifest: list[dict]) -> DataFrame:
    """The manifest as a table, one shard a partition."""
    schema = "shard int, path string, start long"
    if not manifest:
        return spark.createDataFrame([], schema)
    rows = [(m["shard"], m["path"], m["start"]) for m in manifest]
    return spark.createDataFrame(spark.sparkContext.parallelize(rows, len(rows)), schema)


def read_sstables(spark: SparkSession, uri: str) -> DataFrame:
    """Read the shards back: ``doc_id, start, ids``; start counts all ids before the document."""
    return shards_of(spark, manifest_of(uri)).mapInArrow(_read, "doc_id long, start long, ids array<int>")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _read(batches):
        lists = batch.column(2)
        flat, offsets = lists.values.to_numpy().astype("<u4").tobytes(), lists.offsets.to_numpy()
        crc = [zlib.crc32(flat[4 * a : 4 * b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.diff(offsets), pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def sstable_digests(spark: SparkSession, uri: str) -> DataFrame:
    """Per stored document: ``doc_id, start, n_tokens, ids_crc32`` as read from the files."""
    return shards_of(spark, manifest_of(uri)).mapInArrow(_digest, "doc_id long, start long, n_tokens long, ids_crc32 long")
