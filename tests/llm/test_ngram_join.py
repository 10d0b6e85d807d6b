"""The parity-sketch join against brute force over sets of word tuples."""

import random
import re

import pytest
from pyspark.sql import functions as F

from matchguard.llm import ngram_join as nj
from matchguard.llm.common import join_spread
from matchguard.llm.components import components

SCHEMA = "doc_id long, text string, lang string, node string, key int"


def brute_sets(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    k = min(5, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute(rows):
    sets = [brute_sets(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = root(i)
        if d is not None:
            least[r] = min(d, least.get(r, d))
    return sorted(((d, len(s), least.get(root(i), d)) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(d, t, "en", "clash", 1) for d, t in rows], SCHEMA)
    return sorted((tuple(r) for r in nj.near_duplicates(df, **kw).collect()), key=repr)


def edited(rnd, words, vocabulary, share):
    out = list(words)
    for _ in range(max(1, int(len(out) * share))):
        out[rnd.randrange(len(out))] = rnd.choice(vocabulary)
    return out


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "ONE"), (6, "a b c d"), (7, "a b c d e"), (8, "A b c d E"), (9, "a b c d f"), (None, "a b c d e"), (None, "lone text that is here alone"), (12, "a b c d e"), (12, "é É x y z w"), (13, "\x0bé\x0cÉ x\ry z w"), (14, "x" * 200_000)]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


@pytest.mark.parametrize("seed", [1, 2])
def test_random_near_copies(spark, seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    passage = [rnd.choice(vocabulary) for _ in range(50)]
    for _ in range(25):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([4, 6, 9, 14, 30, 60, 130, 400]))]
        if rnd.random() < 0.5:
            base += passage
        for _ in range(rnd.randint(1, 6)):
            rows.append((n, " ".join(edited(rnd, base, vocabulary, rnd.choice([0, 0.005, 0.01, 0.02, 0.04])))))
            n += 1
    assert run(spark, rows) == brute(rows)


def test_large_groups_of_near_copies_and_a_common_passage(spark):
    rnd = random.Random(5)
    vocabulary = [f"v{i}" for i in range(3000)]
    base = [rnd.choice(vocabulary) for _ in range(120)]
    passage = [rnd.choice(vocabulary) for _ in range(60)]
    rows = [(i, " ".join(edited(rnd, base, vocabulary, rnd.choice([0.01, 0.02, 0.03])))) for i in range(150)]
    rows += [(1000 + i, " ".join([rnd.choice(vocabulary) for _ in range(60)] + passage)) for i in range(120)]
    rows += [(2000 + i, rows[0][1]) for i in range(100)]
    rnd.shuffle(rows)
    assert run(spark, rows) == brute(rows)


def test_keep_one_keeps_columns_and_one_of_each_group(spark):
    rows = [(3, "a b c d e f"), (1, "a b c d e f"), (2, "q r s t u"), (None, "a b c d e f"), (4, None), (1, "A b c d e f"), (2, "q r s t u"), (2, "other words of the same id"), (None, "no id and a text of its own"), (None, "no id and a text of its own"), (6, ""), (None, None)]
    df = spark.createDataFrame([(d, t, "en", "clash", 1) for d, t in rows], SCHEMA)
    out = nj.keep_one(df)
    assert out.columns == df.columns
    assert sorted((r["doc_id"] for r in out.collect()), key=repr) == [1, 2, 2, 4, 6, None, None]
    assert sorted(r["text"] for r in out.collect() if r["doc_id"] == 2) == ["other words of the same id", "q r s t u"]


def test_sketch_distance_never_exceeds_the_symmetric_difference():
    rnd = random.Random(3)
    bands = nj.Bands()
    for _ in range(200):
        n = rnd.randint(1, 300)
        a = [rnd.randrange(10**6) for _ in range(n)]
        b = [x if rnd.random() > 0.1 else rnd.randrange(10**6) for x in a]
        x, y = (nj.shingles(" ".join(map(str, s))) for s in (a, b))
        common = len(set(x.tolist()) & set(y.tolist()))
        if bands.linked(common, len(x), len(y)):
            band = min(bands.of(len(x))[0], bands.of(len(y))[0])
            assert len(x) + len(y) - 2 * common <= bands.gap[band]
            assert band in bands.of(len(x)) and band in bands.of(len(y))
            assert set(bands.sketch(x, band).tolist()) & set(bands.sketch(y, band).tolist())


def crossing(spark, df, per_tile, best=False):
    """What the last step finds when every document is a component of its own."""
    bands = nj.Bands()
    texts = df.selectExpr("doc_id as node", "text").mapInArrow(nj._texts(bands), "node long, text string, bits binary")
    alone = df.selectExpr("doc_id as node", "doc_id as component")
    return {(r["a"], r["b"]) for r in nj._crossing(nj._placed(alone, texts, 80, per_tile), alone, texts, 80, best).collect()}


def test_hamming_distance_rules_out_no_link_and_most_others():
    rnd = random.Random(4)
    bands = nj.Bands()
    killed = 0
    for _ in range(300):
        n = rnd.randint(1, 400)
        a = [rnd.randrange(10**6) for _ in range(n)]
        b = [x if rnd.random() > rnd.choice([0.01, 0.1]) else rnd.randrange(10**6) for x in a] + [rnd.randrange(10**6) for _ in range(rnd.choice([0, n // 10]))]
        x, y = (nj.shingles(" ".join(map(str, s))) for s in (a, b))
        common = len(set(x.tolist()) & set(y.tolist()))
        within = bands.within(nj.read_bits(bands.bits(x)), nj.read_bits(bands.bits(y)))
        if bands.linked(common, len(x), len(y)):
            assert within
        elif common < 0.7 * (len(x) + len(y) - common) and n > 20:
            killed += not within
            assert not within
    assert killed > 20


def test_a_group_of_many_sets_that_share_most_words_makes_no_pairs(spark):
    rnd = random.Random(6)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(400):  # each with a run of words of its own, too long for a link
        at = rnd.randrange(0, 120)
        rows.append((i, " ".join(base[:at] + [f"own{i}_{j}" for j in range(22)] + base[at:])))
    df = spark.createDataFrame([(d, t, "en", "clash", 1) for d, t in rows], SCHEMA)
    assert crossing(spark, df, per_tile=1 << 14) == set()
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_crossing_alone_finds_every_link(spark, seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for _ in range(12):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([3, 5, 12, 40, 150]))]
        rows += [(len(rows) + i, " ".join(edited(rnd, base, vocabulary, 0.01) + [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 3))])) for i in range(10)]
    df = spark.createDataFrame([(d, t, "en", "clash", 1) for d, t in rows], SCHEMA)
    sets = {d: brute_sets(t) for d, t in rows}
    links = {(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    found = crossing(spark, df, per_tile=3)
    assert found == crossing(spark, df, per_tile=1 << 14)
    nearest = crossing(spark, df, per_tile=3, best=True)
    assert nearest <= found and {x for p in nearest for x in p} == {x for p in found for x in p}
    assert links <= found
    assert len(links) > 50


def test_join_spread_is_a_left_join_whatever_is_frequent(spark):
    rows = [(i, 7) for i in range(500)] + [(i, i) for i in range(500, 560)] + [(i, None) for i in range(600, 640)] + [(900, 8), (None, 7), (None, None)]
    side = [(7, "hot")] + [(i, f"v{i}") for i in range(500, 540)]
    a, b = spark.createDataFrame(rows, "id long, key long"), spark.createDataFrame(side, "key long, value string")
    want = sorted(((i, k, dict(side).get(k)) for i, k in rows), key=repr)
    for share in (1, 3, 10_000):  # no key, one key, every key by broadcast
        assert sorted((tuple(r) for r in join_spread(a, b, "key", "id", share).collect()), key=repr) == want
    assert join_spread(a.where("false"), b, "key", "id").count() == 0 and join_spread(a, b.where("false"), "key", "id").where("value is not null").count() == 0


@pytest.mark.parametrize("kind", ["path", "star", "random"])
def test_components(spark, kind):
    rnd = random.Random(7)
    edges = {"path": [(i, i + 1) for i in range(300)], "star": [(500, i) for i in range(200)], "random": [(rnd.randrange(400), rnd.randrange(400)) for _ in range(250)]}[kind]
    up = {v: v for e in edges for v in e}

    def root(v):
        while up[v] != v:
            v = up[v]
        return v

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    want = {v: root(v) for e in edges if e[0] != e[1] for v in e}
    df = spark.createDataFrame(edges + [(None, 1), (2, None)], "a long, b long").repartition(16, F.rand(1))
    assert {r["node"]: r["component"] for r in components(df).collect()} == want
