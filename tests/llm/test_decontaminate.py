"""Leak search against exhaustive BM25 and planted items."""

import random

import numpy as np

from matchguard.llm import decontaminate as dc

DOCS = "doc_id long, text string, lang string, item_id string, score int"


def world(seed, items=60, vocabulary=500):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    weights = [1 / (i + 1) for i in range(vocabulary)]
    make = lambda n: rnd.choices(words, weights, k=n)
    bench = [(i, " ".join(make(rnd.randint(8, 30))) + ". " + " ".join(make(rnd.randint(2, 90))) + ".") for i in range(items)]
    return rnd, make, bench


def test_search_finds_all_and_only_segments_above_the_threshold():
    rnd, make, bench = world(1)
    index = dc.Index(bench)
    passages = [make(64) for _ in range(200)] + [dc.words_of(t)[:64] for _, t in bench]
    for threshold in (0.3, 0.5, 0.8):
        pairs = sorted({(p, index.terms[w]) for p, ws in enumerate(passages) for w in ws if w in index.terms})
        p, t = np.array(pairs).T
        found = index.search(p, t, len(passages), threshold, cells=2000)
        got = {(a, b): s for a, b, s in zip(*(x.tolist() for x in found))}
        want = {}
        for a, ws in enumerate(passages):
            score = np.zeros(index.n_entries)
            for w in set(ws):
                if w in index.terms:
                    k = index.terms[w]
                    for j in range(index.at[k], index.at[k + 1]):
                        score[index.entry[j]] += index.impact[j]
            want |= {(a, int(e)): score[e] for e in np.flatnonzero(score >= threshold)}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)


def test_planted_items_are_found_and_clean_documents_left(spark):
    rnd, make, bench = world(2)
    docs, planted = [], set()
    for d in range(60):
        w = make(rnd.randint(0, 400))
        if d % 3 == 0:
            i = rnd.randrange(len(bench))
            leak = bench[i][1].upper().split(" ")
            if len(leak) > 20:
                leak[5] = "edited"
            at = rnd.randint(0, len(w))
            w[at:at] = leak
            planted.add((d, i))
        docs.append((d, " ".join(w), "en", "x", 1))
    docs += [(100, None, None, None, None), (101, "", "en", "x", 1), (None, bench[0][1], "en", "x", 1)]
    df = spark.createDataFrame(docs, DOCS)
    b = spark.createDataFrame([(i, t, "extra") for i, t in bench] + [(900, None, ""), (901, "", "")], "item_id long, text string, doc_id string")
    want = planted | {(None, 0)}
    scores = []
    for size in (16 << 20, 2000):  # one piece, several pieces
        rows = dc.find_leaks(df, b, piece_bytes=size).collect()
        got = {(r["doc_id"], r["item_id"]) for r in rows}
        scores.append({(r["doc_id"], r["item_id"]): round(r["score"], 9) for r in rows})
        assert want <= got and {d for d, _ in got} == {d for d, _ in want}
        kept = dc.keep_unleaked(df, b, piece_bytes=size)
        assert kept.columns == df.columns
        assert {r["doc_id"] for r in kept.collect()} == {d[0] for d in docs} - {d for d, _ in want}
    assert scores[0] == scores[1]  # statistics are those of all items, however they are cut


def test_empty_tables(spark):
    df, none = spark.createDataFrame([(1, "a b c", "en", "", 1)], DOCS), spark.createDataFrame([], DOCS)
    b, empty = spark.createDataFrame([(1, "x y z w")], "item_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert dc.find_leaks(df, empty).count() == dc.find_leaks(none, b).count() == 0
    assert dc.keep_unleaked(df, empty).count() == 1
