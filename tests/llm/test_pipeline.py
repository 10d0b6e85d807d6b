"""Every stage of the pipeline against a plain version, each on its own input."""

import base64
import hashlib
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from test_ngram_join import brute  # noqa: E402

import corpus_pipeline
from matchguard.llm import decontaminate, toxicity
from matchguard.llm.queries import split_pattern, table, tokenizer_path

SF = "/root/testdata/sf0.001"


def stage_rows(spark, docs, k, tmp_path):
    path = f"{tmp_path}/{k}"
    corpus_pipeline.STAGES[k][1](spark, docs, SF).write.parquet(path)
    return spark.read.parquet(path)


def plain_noisy_or(model, text):
    keep = 1.0
    for p in model.sentences(text):
        keep *= 1 - p
    return 1 - keep


def test_stages(spark, tmp_path):
    docs = table(spark, SF, "documents")
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    model = toxicity.fit(docs, table(spark, SF, "labels"))
    one = stage_rows(spark, docs, 0, tmp_path)
    assert one.columns == docs.columns and ids(one) == {d for d, t in text.items() if plain_noisy_or(model, t or "") < 0.3}

    two = stage_rows(spark, one, 1, tmp_path)
    left = sorted(ids(one))
    assert two.columns == docs.columns and ids(two) == {d for d, _, c in brute([(d, text[d]) for d in left]) if d == c}

    def leaked(t):
        w = decontaminate.words_of(t)
        have = {tuple(w[i : i + 3]) for i in range(len(w) - 2)}
        for r in items:
            q, a = decontaminate.question_and_answer(r["text"])
            grams = [tuple(q[i : i + 3]) for i in range(len(q) - 2)]
            if grams and sum(g in have for g in grams) >= 0.5 * len(grams) and sum(x in set(w) for x in a) >= 0.5 * len(a):
                return True
        return False

    items = table(spark, SF, "benchmark").collect()
    three = stage_rows(spark, two, 2, tmp_path)
    assert three.columns == docs.columns and ids(three) == {d for d in ids(two) if not leaked(text[d])}

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(tokenizer_path("byte_bpe_50k.tiktoken"), "rb"))}
    want = tiktoken.Encoding("own", pat_str=split_pattern(), mergeable_ranks=ranks, special_tokens={})
    four = stage_rows(spark, three, 3, tmp_path)
    got = {r["doc_id"]: tuple(r)[1:] for r in four.collect()}
    assert got.keys() == ids(three)
    for d, row in got.items():
        i = want.encode_ordinary(text[d] or "")
        assert row == (len(i), hashlib.sha256(" ".join(map(str, i)).encode()).hexdigest(), hashlib.sha256((text[d] or "").encode()).hexdigest())
    assert {tuple(r) for r in corpus_pipeline.run(spark, SF).collect()} == {tuple(r) for r in four.collect()}


def test_stages_take_odd_rows_and_clashing_columns(spark, tmp_path):
    schema = "doc_id long, text string, lang string, score double, node string, ids string, item_id string"
    rows = [(1, None, None, 0.5, "x", "y", "z"), (2, "", "en", None, "x", "y", "z"), (None, "a b c d e f", "en", 1.0, "x", "y", "z"), (3, "a b c d e f", "en", 1.0, "x", "y", "z"), (3, "a b c d e f", "en", 1.0, "x", "y", "z"), (4, "word " * 30_000, "en", 1.0, "x", "y", "z")]
    for n, data in (("odd", rows), ("none", [])):
        docs = spark.createDataFrame(data, schema)
        for k in range(3):
            docs = stage_rows(spark, docs, k, f"{tmp_path}/{n}")
            assert docs.columns == [c.split()[0] for c in schema.split(", ")]
        assert stage_rows(spark, docs, 3, f"{tmp_path}/{n}").count() == docs.count() == (4 if data else 0)
