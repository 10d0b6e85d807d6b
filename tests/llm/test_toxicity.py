"""Noisy-or multiple-instance learning: held-out accuracy, located sentences, odd rows."""

import random
import zlib

import numpy as np

from matchguard.llm import toxicity as tx

DOCS, LABELS = "doc_id long, text string, score string, toxic string", "doc_id long, quality int, toxic int, text string"


def world(n=900, seed=1):
    rnd = random.Random(seed)
    words, bad = [f"word{i}" for i in range(300)], ["vile", "rotten", "foulest"]
    docs, labels, truth = [], [], {}
    for i in range(n):
        s = [[rnd.choice(words) for _ in range(rnd.randint(3, 12))] for _ in range(rnd.randint(1, 25))]
        truth[i] = []
        if i % 6 == 0:
            for k in rnd.sample(range(len(s)), min(len(s), 2)):
                s[k].insert(rnd.randint(0, len(s[k])), rnd.choice(bad))
                truth[i].append(k)
        docs.append((i, ". ".join(" ".join(x) for x in s).capitalize() + ".", "clash", "clash"))
        labels.append((i, 1, int(i % 6 == 0), "clash"))
    return docs, labels, truth


def test_held_out_documents_and_sentences(spark):
    docs, labels, truth = world()
    df, lab = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    model = tx.fit(df, lab)
    out = {r["doc_id"]: r for r in tx.score_documents(df, model).withColumn("h", tx.held_out()).collect()}
    held = [i for i in out if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(out[i]["h"] == (i in set(held)) for i in out) and len(held) > 100
    assert np.mean([(out[i]["score"] >= 0.3) == (i % 6 == 0) for i in held]) > 0.98
    found = {}
    for r in tx.locate(df, model).collect():
        found.setdefault(r["doc_id"], []).append(r["sentence"])
        assert docs[r["doc_id"]][1][r["start"] : r["end"]].strip() == r["text"]
    hit = sum(len(set(found.get(i, [])) & set(truth[i])) for i in held)
    assert hit >= 0.9 * sum(len(truth[i]) for i in held) and hit >= 0.9 * sum(len(found.get(i, [])) for i in held)
    kept = tx.keep_clean(df, model)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i in out if out[i]["score"] < 0.3}


def test_noisy_or_of_sentence_scores():
    model = tx.NoisyOr(["bad", "goo*", "goi*", "gob*"], np.array([4.0, 3.0, 3.0, 3.0]), -3.0)
    p = model.sentences("Good bad day. going; GOBAD!\n\n... nothing here")
    z = np.array([4.0 + 3.0 - 3.0, 3.0 + 3.0 - 3.0, -3.0])
    assert np.allclose(p, 1 / (1 + np.exp(-z)))
    assert abs(model.score("Good bad day. going; GOBAD!\n\n... nothing here")[0] - (1 - np.prod(1 - p))) < 1e-9


def test_odd_rows_and_missing_labels(spark):
    rows = [(1, None, "c", "c"), (2, "", "c", "c"), (3, "...\n", "c", "c"), (None, "word", "c", "c"), (4, "word. " * 20_000, "c", "c"), (4, "word", "c", "c")]
    df = spark.createDataFrame(rows, DOCS)
    none = spark.createDataFrame([], LABELS)
    model = tx.fit(df, none)
    got = sorted((r["score"] for r in tx.score_documents(df, model).collect()))
    assert got == [0.0] * 6
    only = spark.createDataFrame([(4, 1, 1, "c"), (4, 1, None, "c"), (None, 1, 1, "c"), (9, None, 0, "c")], LABELS)
    assert {r["score"] for r in tx.score_documents(df, tx.fit(df, only)).collect()} == {0.0, 1.0}
    trained = tx.NoisyOr(["word"], np.array([9.0]), -3.0)
    scores = {(r["doc_id"], r["n_sentences"]): r["score"] for r in tx.score_documents(df, trained).collect()}
    assert scores[1, 0] == scores[2, 0] == scores[3, 0] == 0 and scores[4, 20_000] > 0.999
    assert tx.keep_clean(df.limit(0), trained).count() == 0
