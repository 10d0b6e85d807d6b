"""Shards, counts and BPE against the public libraries."""

import base64
import hashlib
import io
import random
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchguard.llm import bpe, sstable, token_count
from matchguard.llm.queries import split_pattern, tokenizer_path

SCHEMA = "doc_id long, text string, n_tokens string, ids string"
ODD = ["", " ", "  ", "a  b", " a", "a ", "a \n b", "a\n \nb", "\n\n x", "x \n\n", "\t a\t b ", "don't we'll go 123 4567 !! ??", "é ü ß 中文字 字", "<|endoftext|> a<|startoftext|>b", "a\x1c b \x1d c", "x" * 3000, "😀😀 👍🏽a", "a ▁b ▁▁c", "\r\n a \r\n", "İI ΑΣ Σ.", "J̌ x", "A.B,c!?'s", "<s> </s>", "İSTANBUL BELEDİYESİ.", "TÜRKİYE CUMHURİYETİ, 1923", "xİ.", "▁▁ ▁▁", "a▁ ▁ ▁b"]
#: Letters whose lower case is no single letter, combining marks, white space of all kinds, the pieces' own sign, astral letters.
ALPHABET = [*"abzAZ .,!?'\"-09éİıŞΣςЖ中ſßﬁÀÅªº²½", "\u0307", "\u0301", "\u0327", "\u0345", "▁", "\u00a0", "\u2003", "\u3000", "\u200b", "\t", "\n", "😀", "\U0001d400", *"      ", "İ.", "s'", "<|endoftext|>"]


def wild(seed=3, n=20_000):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 30))) for _ in range(n)]


def texts(seed=1, n=400):
    rnd = random.Random(seed)
    return ODD + ["".join(rnd.choice("abAB .,\n\t '1é　<|>") for _ in range(rnd.randint(0, 40))) for _ in range(n)]


def table(spark, rows):
    return spark.createDataFrame([(d, t, "clash", "clash") for d, t in rows], SCHEMA)


def rows_of(seed=1):
    rows = [(i * 7 - 50, t) for i, t in enumerate(texts(seed))] + [(5000, None), (None, "no id"), (5001, "twice"), (5001, "twice"), (5001, "other")]
    random.Random(seed).shuffle(rows)
    return rows


def test_bpe_equals_the_library_and_round_trips(spark):
    import tiktoken

    path, pattern = tokenizer_path("byte_bpe_50k.tiktoken"), split_pattern()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    want = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    codec = bpe.ByteBPE(path, pattern, limit=50)
    for t in texts(2, 1500):
        ids = codec.encode_batch([t])[0]
        assert ids.tolist() == want.encode_ordinary(t)
        assert codec.decode(ids) == t.encode()
    rows = rows_of()
    df = table(spark, rows)
    enc = bpe.encode_documents(df, path, pattern)
    key = lambda r: repr(r)
    assert sorted(((r["doc_id"], r["ids"]) for r in enc.collect()), key=key) == sorted(((d, want.encode_ordinary(t or "")) for d, t in rows), key=key)
    assert sorted(((r["doc_id"], bytes(r["bytes"])) for r in bpe.decode_documents(enc, path, pattern).collect()), key=key) == sorted(((d, (t or "").encode()) for d, t in rows), key=key)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    digests = sorted((tuple(r) for r in bpe.round_trip_digests(df, path, pattern).collect()), key=key)
    assert digests == sorted(((d, len(i), sha(" ".join(map(str, i)).encode()), sha((t or "").encode())) for d, t in rows for i in [want.encode_ordinary(t or "")]), key=key)
    assert bpe.round_trip_digests(df.where(F.lit(False)), path, pattern).count() == 0
    with pytest.raises(ValueError):
        codec.decode(np.array([10**6]))


def test_long_pre_tokens_equal_the_library_in_little_time():
    import tiktoken

    path, pattern = tokenizer_path("byte_bpe_50k.tiktoken"), split_pattern()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    want = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    codec, rnd = bpe.ByteBPE(path, pattern), random.Random(8)
    for t in ("a" * 50_000, "".join(rnd.choice("ACGT") for _ in range(100_000)), "".join(rnd.choice("etaoinshrdlu") for _ in range(bpe.LONG + 1)), "".join(rnd.choice("etaoinshrdlu") for _ in range(bpe.LONG)), "é中" * 9_000, "!?" * 5_000):
        start = time.process_time()
        ids = codec.encode_batch([t])[0]
        assert time.process_time() - start < 10
        assert ids.tolist() == want.encode_ordinary(t)


def test_pair_table_holds_every_pair():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 3000, (5000, 2)), axis=0)
    pairs = bpe.PairTable(keys[:, 0], keys[:, 1], np.arange(len(keys), dtype=np.int32))
    assert (pairs.find(keys[:, 0], keys[:, 1]) == np.arange(len(keys))).all()
    assert (pairs.find(np.array([3001, -1]), np.array([1, 1])) == bpe.NONE).all()


def test_counts_equal_the_library(spark):
    import sentencepiece

    path = tokenizer_path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = rows_of(3)
    got = sorted((tuple(r) for r in token_count.count_tokens(table(spark, rows), path, max_tokens=30).collect()), key=repr)
    want = [(d, len((t or "").encode()), n, n > 30) for d, t in rows for n in [len(model.encode(t or ""))]]
    assert got == sorted(want, key=repr)
    small = token_count.PieceCounter(path, limit=3)
    for t in texts(4, 500):
        assert small.count([t]) == [len(model.encode(t))]
    assert token_count.count_tokens(table(spark, []), path).count() == 0


def test_wild_texts_equal_the_libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    texts = wild()
    path = tokenizer_path("word_bpe_49k.json")
    coder = sstable.ChunkEncoder(path)
    want = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    assert [t for t, a, b in zip(texts, coder.encode(texts), want) if np.frombuffer(a, coder.kind).tolist() != b.ids] == []
    path = tokenizer_path("piece_bpe_32k.model")
    want = sentencepiece.SentencePieceProcessor(model_file=path).encode(texts)
    assert [t for t, n, b in zip(texts, token_count.PieceCounter(path).count(texts), want) if n != len(b)] == []


def test_chunk_encoder_equals_the_library():
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), sstable.ChunkEncoder(path, limit=50)
    for t in texts(5, 1500):
        assert np.frombuffer(own.encode([t])[0], own.kind).tolist() == library.encode(t, add_special_tokens=False).ids


def test_shards_round_trip_through_spark(spark, tmp_path):
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    library, rows, uri = Tokenizer.from_file(path), rows_of(6), f"file://{tmp_path}/shards"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    manifest = sstable.write_sstables(table(spark, rows), uri, path, end_id=2)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(manifest) > 1
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in sstable.sstable_digests(spark, uri).collect())
    ids = lambda t: [*library.encode(t or "", add_special_tokens=False).ids, 2]
    assert [g[1] for g in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d))
    assert [g[0] for g in got] == [0, *np.cumsum([g[2] for g in got])[:-1].tolist()]
    crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
    assert sorted(((g[1], g[2], g[3]) for g in got), key=repr) == sorted(((d, len(i), crc(i)) for d, t in rows for i in [ids(t)]), key=repr)
    by_id = {}
    for d, t in rows:
        by_id.setdefault(d, []).append(ids(t))
    for d in [None, 5000, 5001, -50, rows[3][0]]:
        assert sorted(v.tolist() for v in sstable.lookup(uri, d)) == sorted(by_id[d])
    assert sstable.lookup(uri, 10**9) == []
    full = sstable.read_sstables(spark, uri).collect()
    assert sorted(r["ids"] for r in full) == sorted(ids(t) for _, t in rows)
    assert sstable.write_sstables(table(spark, []), f"{uri}-none", path, end_id=2) == []
    assert sstable.sstable_digests(spark, f"{uri}-none").count() == 0


def test_table_format_finds_every_key_and_damage():
    rnd = random.Random(7)
    keys = sorted(rnd.sample(range(-(10**12), 10**12), 700)) + [10**13] * 40
    out = io.BytesIO()
    table = sstable.SSTableWriter(out, 2, block_bytes=300)
    values = [rnd.randbytes(2 * rnd.randint(0, 40)) for _ in keys]
    for k, v in zip(keys, values):
        table.add(sstable.key_of(k), v)
    table.close()
    reader = sstable.SSTableReader(out)
    assert len(reader.index) > 10 and [sstable.id_of(k) for k, _ in reader] == keys
    for k, v in zip(keys[:700], values):
        assert reader.get(sstable.key_of(k)) == [v]
    assert reader.get(sstable.key_of(10**13)) == values[700:]
    absent = [k for k in range(3000) if k not in set(keys)]
    assert not any(reader.get(sstable.key_of(k)) for k in absent)
    assert sum(reader.may_hold(sstable.key_of(k)) for k in absent) < 0.05 * len(absent)
    broken = bytearray(out.getvalue())
    broken[20] ^= 255
    with pytest.raises(ValueError):
        list(sstable.SSTableReader(io.BytesIO(bytes(broken))))
