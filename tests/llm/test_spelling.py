"""Word counts and near words against plain loops."""

import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from matchguard.llm import spelling as sp

LOWER = {c: c + 32 for c in range(65, 91)}


def counted(rows, typos, min_len=6, min_count=5):
    n = {}
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if typos and h % typos == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] = n.get(run, 0) + 1
    return {w: c for w, c in n.items() if len(w) >= min_len and c >= min_count}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[k:] == b[k + 1 :] or len(a) == len(b) and a[k + 1 :] == b[k + 1 :]


def grouped(words, ratio=5):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        top = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = top if top is not None and words[top] >= ratio * n else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), words[form[w]] if form[w] is not None else None)
    return out


def variants(rng, letters, n, longest=14):
    words = {}
    while len(words) < n:
        w = "".join(rng.choice(letters) for _ in range(rng.randrange(1, longest)))
        for _ in range(rng.randrange(1, 6)):
            words[w] = rng.choice([5, 6, 25, 30, 150, 4000])
            at = rng.randrange(len(w) + 1)
            w = rng.choice([w[:at] + rng.choice(letters) + w[at:], w[:at] + w[at + 1 :], w[:at] + rng.choice(letters) + w[at + 1 :]]) or "a"
    return words


def run(spark, words, **kw):
    df = spark.createDataFrame([(w, n, "clash", 1) for w, n in words.items()], "word string, n long, form string, key int")
    out = sp.group_variants(df, **kw)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = out.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r[0]: tuple(r)[1:] for r in rows}


def test_near_in_list_finds_each_pair_once():
    rng = random.Random(1)
    for _ in range(200):
        words = sorted({"".join(rng.choice("abà") for _ in range(rng.randrange(1, 8))) for _ in range(40)})
        found = [p for base in range(1, 8) for lo, hi in ((0, base // 2), (base // 2, base + 1)) for p in sp.near_in_list(words, base, lo, hi)]
        assert sorted(found) == [(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if one_edit(words[i], words[j])]


@pytest.mark.parametrize("most", [2048, 2])
def test_groups(spark, most):
    words = variants(random.Random(2), "abcé", 400) | {"x" * 3000: 5, "x" * 3001: 30, "x" * 1500 + "y" + "x" * 1500: 7}
    assert run(spark, words, most=most) == grouped(words)


def test_a_shared_beginning_of_most_words_is_cut_into_short_lists(spark):
    rng = random.Random(3)
    words = {"prefixprefix" + "".join(rng.choice("abcdefgh") for _ in range(5)): rng.randrange(5, 500) for _ in range(900)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    lists = sp._lists(df, 20).groupBy("key", "base", "low", "high").count()
    assert lists.where("high - low > 1").agg(F.max("count")).head()[0] <= 20
    assert run(spark, words, most=20) == grouped(words)


def test_chains_end_at_the_last_form(spark):
    words = {"a" * k: 5**k for k in range(1, 14)}
    assert {w: r[1] for w, r in run(spark, words).items()} == {w: "a" * 13 for w in words}


def test_empty_table(spark):
    assert run(spark, {}) == {}
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert sp.count_words(docs).collect() == []


@pytest.mark.parametrize("typos", [None, 3, 199])
def test_counts(spark, monkeypatch, typos):
    rng = random.Random(4)
    stems = ["Straße", "élevées", "ÀÉÎõü", "Hamburg", "color", "colours", "naïveté", "ab", "Zebra×crossing"]
    rows = [(i, " ".join(rng.choice(stems) + rng.choice(["", ".", "9", "\n", "İ"]) for _ in range(rng.randrange(30)))) for i in range(60)]
    rows += [(None, "Hamburg " * 9), (7, None), (8, ""), (9, "q" * 5000), (10, "Elefant, " * 200_000), (3, rows[3][1])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n int, word string")
    got = {r["word"]: r["n"] for r in sp.count_words(df, typos=typos).collect()}
    assert got == counted(rows, typos)


def test_the_sql_gives_the_same_rows(spark):
    duckdb = pytest.importorskip("duckdb")
    import pandas as pd

    rng = random.Random(5)
    stems = list(variants(rng, "abcdefé", 40, 9))
    rows = [(i, " ".join(rng.choice(stems) for _ in range(300))) for i in range(80)] + [(500, None)]
    con = duckdb.connect()
    con.register("documents", pd.DataFrame({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows]}))
    want = {r[0]: tuple(r)[1:] for r in con.execute(sp.SQL).fetchall()}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sp.group_variants(sp.count_words(df, typos=199)).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == want == grouped(counted(rows, 199))
