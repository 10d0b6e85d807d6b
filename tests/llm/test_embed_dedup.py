"""The inverted multi-index against all cosines."""

import numpy as np
import pytest

from matchguard.llm import embed_dedup as ed

SCHEMA = "vec_id long, embedding array<float>, label int, node string, cell double"


def brute(rows, cosine=0.93):
    n = len(rows)
    ok = [label is not None and bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v, label in rows]
    link = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = (np.float32(rows[k][1]).astype(np.float64) for k in (i, j))
                link[i, j] = link[j, i] = a @ b / np.sqrt((a @ a) * (b @ b)) >= cosine
    return link


def answer(rows, link):
    up = np.arange(len(rows))
    changed = True
    while changed:
        new = np.array([min([up[i], *up[link[i]]]) for i in range(len(rows))])
        changed, up = (new != up).any(), new
    ids = [r[0] for r in rows]
    least = {c: min(d for d, u in zip(ids, up) if u == c) for c in set(up.tolist())}
    return {d: (int(link[i].sum()), least[up[i]]) for i, d in enumerate(ids)}


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "clash", 0.5) for r in rows], SCHEMA)
    out = ed.near_duplicates(df, **kw).collect()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in out)
    return {r["vec_id"]: (r["n_links"], r["component_id"]) for r in out}


def vectors(rng, n, dim=16):
    base = rng.normal(size=(n // 4, dim))
    rows = []
    for i in range(n):
        v = base[rng.integers(len(base))] + rng.normal(size=dim) * rng.choice([0.0, 0.05, 0.2, 0.4])
        rows.append((i, [float(x) for x in np.float32(v)], int(rng.integers(3))))
    return rows


def test_traversal_prefix_equals_the_heap_order():
    rng = np.random.default_rng(1)
    index = ed.MultiIndex(rng.normal(size=(7, 4)), rng.normal(size=(6, 4)), reach=3.0)
    x = rng.normal(size=(20, 8))
    rows, cells = index.visited(x)
    d1, d2 = index.costs(x)
    for i in range(len(x)):
        order = list(ed.multi_sequence(d1[i], d2[i]))
        costs = [c for _, _, c in order]
        assert costs == sorted(costs) and len(order) == 42
        want = {a * 6 + b for a, b, c in order if c <= costs[0] + 3.0}
        assert set(cells[rows == i].tolist()) == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    one = [1.0, 0.0, 0.0]
    rows = [(1, one, 1), (2, one, 1), (3, [2.0, 0.0, 0.0], 1), (4, one, 2), (5, one, None), (6, None, 1), (7, [0.0, 0.0, 0.0], 1), (8, [nan, 1.0, 0.0], 1), (9, [inf, 0.0, 0.0], 1), (10, [1.0, None, 0.0], 1), (11, [], 1), (12, [1.0, 0.0], 1), (13, [-1.0, 0.0, 0.0], 1), (14, [1e30, 1e25, 0.0], 1)]
    got = run(spark, rows)
    assert got == answer(rows, brute(rows)) and got[1] == (3, 1)


def test_labels_never_share_a_node(spark):
    v = [1.0, 2.0, -0.5, 0.25]
    rows = [(i, v, label) for i, label in enumerate([-1, -2, 7, 65543, 7 + (1 << 24), 0, 1 << 16])]
    assert run(spark, rows) == {i: (0, i) for i in range(len(rows))}
    assert run(spark, rows + [(100, [2 * x for x in v], -2)], exact=True) == {i: (0, i) for i in range(len(rows)) if i != 1} | {1: (1, 1), 100: (1, 1)}


def test_empty_table(spark):
    assert run(spark, []) == {}


@pytest.mark.parametrize("small_tiles", [False, True])
def test_recall_and_precision(spark, monkeypatch, small_tiles):
    if small_tiles:
        monkeypatch.setattr(ed, "TILE_MEMBERS", 3)
        monkeypatch.setattr(ed, "TILE_QUERIES", 5)
    rows = vectors(np.random.default_rng(2), 400)
    rows += [(1000 + i, rows[0][1], rows[0][2]) for i in range(150)]  # a hot vector
    link = brute(rows)
    got = run(spark, rows)
    counts = np.array([got[r[0]][0] for r in rows])
    assert (counts <= link.sum(1)).all() and counts.sum() >= 0.95 * link.sum()


def test_whole_grid_is_exact(spark):
    rows = vectors(np.random.default_rng(3), 200)
    assert run(spark, rows, codes=1) == answer(rows, brute(rows))


def test_a_hot_near_copy_group_does_not_set_the_reach_of_others(spark):
    rng = np.random.default_rng(7)
    hot = rng.normal(size=64)
    hot = hot / np.linalg.norm(hot) + rng.normal(size=(1000, 64)) * 0.1 / 8  # a third of the vectors, cosine about 0.99
    base = ed.unit(rng.normal(size=(1000, 64)))
    off = rng.normal(size=base.shape)
    off = ed.unit(off - (off * base).sum(1, keepdims=True) * base)
    cosine = rng.uniform(0.931, 0.96, (1000, 1))
    twin = cosine * base + np.sqrt(1 - cosine**2) * off
    x = np.float32(np.concatenate([hot, base, twin]))
    rows = [(i, [float(c) for c in v], 1) for i, v in enumerate(x)]
    u = ed.unit(x)
    link = u @ u.T >= 0.93
    degree = link.sum(1) - 1
    got = run(spark, rows)
    counts = np.array([got[i][0] for i in range(len(rows))])
    assert (counts <= degree).all()
    others = np.arange(len(rows)) >= 1000
    assert (counts / np.maximum(degree, 1))[others & (degree > 0)].mean() >= 0.97
    assert counts[~others].sum() >= 0.97 * degree[~others].sum()


def _shuffled(spark, since=0):
    """Bytes that stages from ``since`` on wrote to shuffles, and the next stage's number."""
    sc = spark.sparkContext
    none = sc._jvm.java.util.ArrayList()
    stages = sc._jsc.sc().statusStore().stageList(none, False, False, sc._gateway.new_array(sc._jvm.double, 0), none)
    held = [(stages.apply(i).stageId(), stages.apply(i).shuffleWriteBytes()) for i in range(stages.size())]
    return sum(b for n, b in held if n >= since), max((n for n, _ in held), default=-1) + 1


def test_a_vector_is_not_sent_once_for_each_cell(spark):
    """what is shuffled is a few times the vectors, however fine the grid."""
    x = np.float32(np.random.default_rng(9).normal(size=(6000, 64)))
    rows = [(i, v, 1, "clash", 0.5) for i, v in enumerate(x.tolist())]
    df = spark.createDataFrame(rows, SCHEMA)
    _, first = _shuffled(spark)
    assert ed.near_duplicates(df).where("n_links > 0").count() == 0
    written, _ = _shuffled(spark, first)
    assert written <= 6 * x.nbytes


def test_several_regions_and_parts_keep_the_links(spark, monkeypatch):
    """links between regions, between parts of a region and within a part, each counted once."""
    monkeypatch.setattr(ed, "LEAST", 40)
    monkeypatch.setattr(ed, "BLOCK", 7)
    rows = vectors(np.random.default_rng(12), 800, dim=24)
    link = brute(rows)
    got = run(spark, rows)
    counts = np.array([got[r[0]][0] for r in rows])
    assert (counts <= link.sum(1)).all() and counts.sum() >= 0.97 * link.sum()
    assert run(spark, rows, exact=True) == answer(rows, link)
