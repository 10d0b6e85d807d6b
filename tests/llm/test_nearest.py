"""The inverted multi-index for nearest neighbours against all distances."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchguard.llm import nearest as nn

SCHEMA = "vec_id long, embedding array<double>, label int, node string, rank int, dim double"


def usable(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def brute(rows, asks, k):
    ok = [(i, np.array(v, float)) for i, v in {(i, tuple(v)) for i, v in rows if i is not None and usable(v)}]
    out = []
    for q, v in ok:
        if asks(q):
            near = sorted({(math.dist(w, v), i) for i, w in ok if i != q and len(w) == len(v)})
            out += [(q, r + 1, i, d) for r, (d, i) in enumerate(near[:k])]
    return sorted(out)


def run(spark, rows, queries, **kw):
    df = spark.createDataFrame([(*r, 1, "clash", 7, 0.5) for r in rows], SCHEMA)
    out = nn.nearest(df, queries, **kw)
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in out.collect())


def close(got, want):
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in got], [r[3] for r in want], rtol=1e-12, atol=0)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    one = [1.0, 0.0, 0.0]
    rows = [(0, one), (2, one), (4, [2.0, 0.0, 0.0]), (4, [2.0, 0.0, 0.0]), (5, one), (6, None), (7, [0.0, 0.0, 0.0]), (8, [nan, 1.0, 0.0]), (10, [inf, 0.0, 0.0]), (11, [1.0, None, 0.0]), (12, []), (14, [1.0, 0.0]), (16, [-1.0, 0.0, 0.0]), (None, one), (18, [1.0, 1e-170, 0.0])]
    close(run(spark, rows, F.col("vec_id") % 2 == 0, k=3), brute(rows, lambda q: q % 2 == 0, 3))


def test_distances_of_tiny_and_huge_values():
    x = np.array([[3e200, 4e200], [3e-200, 4e-200], [0.0, 0.0], [3.0, 4.0]])
    assert np.allclose(nn.distances(x, np.zeros(2)), [5e200, 5e-200, 0, 5], rtol=1e-14, atol=0)


def test_empty_table_and_no_query(spark):
    assert run(spark, [], F.col("vec_id") == 1) == []
    assert run(spark, [(1, [1.0]), (2, [2.0])], F.lit(None).cast("boolean")) == []


def test_fewer_candidates_than_k(spark):
    rows = [(i, [float(i), 1.0]) for i in range(4)]
    close(run(spark, rows, F.col("vec_id") < 2, k=10), brute(rows, lambda q: q < 2, 10))


def test_copies_are_one_entry_with_its_smallest_ids(spark):
    rows = [(i, [1.0, 2.0]) for i in range(300)] + [(1000, [1.0, 2.5])]
    got = run(spark, rows, F.col("vec_id").isin(0, 5, 299, 1000), k=10)
    close(got, brute(rows, lambda q: q in (0, 5, 299, 1000), 10))


@pytest.mark.parametrize("small", [False, True])
def test_recall_with_a_hot_group(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(nn, "BLOCK", 16)
        monkeypatch.setattr(nn, "BLOCK_QUERIES", 3)
    rng = np.random.default_rng(4)
    hot = rng.normal(size=12) + rng.normal(size=(400, 12)) * 0.01
    x = np.concatenate([hot, rng.normal(size=(800, 12))])
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    want, got = brute(rows, lambda q: q % 20 == 0, 10), run(spark, rows, F.col("vec_id") % 20 == 0)
    assert len(got) == len(want) == 600
    found = {(r[0], r[2]): r[3] for r in got}
    assert all(np.isclose(found[(q, i)], np.linalg.norm(x[q] - x[i]), rtol=1e-12) for q, i in found)
    assert len(found.keys() & {(r[0], r[2]) for r in want}) >= 0.93 * len(want)


def test_one_code_a_half_is_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(200, 5)))]
    close(run(spark, rows, F.col("vec_id") % 10 == 0, codes=1), brute(rows, lambda q: q % 10 == 0, 10))


def test_walk_takes_cells_nearest_first():
    rng = np.random.default_rng(6)
    grid = nn.Grid(rng.normal(size=(5, 3)), rng.normal(size=(4, 3)))
    grid.fill(np.array([0, 3, 7, 12, 19]), np.array([1, 2, 9000, 1, 3]))
    d1, d2 = grid.costs(rng.normal(size=(1, 6)))
    cost = [d1[0, c // 4] + d2[0, c % 4] for c, _ in grid.walk(d1[0], d2[0])]
    assert cost == sorted(cost) and len(cost) == 5
    grid.length = 1.0
    assert len(grid.visited(d1[0], d2[0], 1)) <= 2 and len(grid.visited(d1[0], d2[0], 10_000)) == 5
    assert grid.parts[7] == 3 and len(set(grid.block[[0, 3]])) == 1 and grid.block[12] >= grid.block[7] + 3
