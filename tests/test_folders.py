"""Digests of files by rows and by ranges."""

import gzip
import hashlib
import tracemalloc

from matchguard.sources import folders


def test_digests_by_rows_and_by_ranges_are_those_of_the_bytes(spark, tmp_path):
    data = {"a/empty.bin": b"", "a/one.bin": b"x", "b=1/four.bin": b"abcd", "b=1/over.bin": b"abcde" * 1000, "b=1/odd %41 name.bin": bytes(range(256)) * 41, "c/text.gz": gzip.compress(b"text" * 500)}
    for name, body in data.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(body)
    want = {name: hashlib.sha256(body).hexdigest() for name, body in data.items()}
    listed = {name: sha for name, sha in want.items() if name != "a/empty.bin"}
    for whole in (0, 4, 1 << 20):  # nearly all by ranges, some, none
        got = {r["path"].split(f"{tmp_path}/")[1]: r["sha"] for r in folders.file_digests(spark, str(tmp_path), whole=whole).collect()}
        assert got == listed
    one = hashlib.sha256(want["a/one.bin"].encode()).hexdigest()
    sums = {r["folder"].rsplit("/", 1)[1]: r["checksum_sha256"] for r in folders.checksums(spark, [str(tmp_path)], "*.bin").collect()}
    assert set(sums) == {"a", "b=1"} and sums["a"] == one


def test_no_row_holds_a_file_over_the_limit(spark, tmp_path):
    (tmp_path / "f.bin").write_bytes(b"0" * 5000)
    plan = folders.file_digests(spark, str(tmp_path), whole=4999)._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(length,4999)" in plan and "GreaterThan(length,4999)" in plan and plan.count("content") and "ReadSchema: struct<path:string,length:bigint>" in plan


def test_ranges_need_the_memory_of_one_chunk(tmp_path):
    path = tmp_path / "large.bin"
    block, digest = bytes(1 << 20), hashlib.sha256()
    with path.open("wb") as f:
        for k in range(96):
            part = bytes([k]) + block[1:]
            f.write(part)
            digest.update(part)
    tracemalloc.start()
    try:
        assert folders.sha256_of(f"file:{path}", chunk=1 << 20) == digest.hexdigest()
        assert tracemalloc.get_traced_memory()[1] < 6 << 20
    finally:
        tracemalloc.stop()
