"""The masked pseudo-likelihood: against a token-by-token loop, and better than counts on held-out text."""

import random

import numpy as np
from pyspark.sql import functions as F

from matchguard.llm import lm_score as lm

SCHEMA = "doc_id long, text string, n_tokens string"


def corpus(seed, n):
    """Words come in fixed triples, so neighbours tell a word."""
    rnd = random.Random(seed)
    triples = [(f"a{i}", f"b{i}", f"c{i}") for i in range(40)]
    return [(i, " ".join(w for _ in range(rnd.randint(5, 60)) for w in rnd.choice(triples)), "clash") for i in range(n)]


def test_training_beats_counts_on_held_out_text_and_order_matters(spark):
    docs = spark.createDataFrame(corpus(1, 1500), SCHEMA).repartition(3)
    net, tables = lm.fit(docs)
    held = [t for _, t, _ in corpus(2, 80)]
    total, size = lm.log_likelihoods(held, net, tables)
    counts = lm.count_ids(docs)
    share = np.log((counts + 1) / (counts + 1).sum())
    plain = sum(share[lm.token_ids(t)].sum() for t in held)
    assert total.sum() / size.sum() > plain / size.sum() + 0.5
    rnd = random.Random(3)
    mixed = [" ".join(rnd.sample(t.split(), len(t.split()))) for t in held]
    assert (lm.log_likelihoods(mixed, net, tables)[0] < total).mean() > 0.95


def test_scores_equal_a_loop_over_tokens(spark):
    rows = corpus(4, 20) + [(100, None, "x"), (101, "", "x"), (102, " \t ", "x"), (103, "one", "x"), (None, "a1 b1", "x"), (104, "a1 b1", "x"), (104, "a1 b1", "x"), (105, "w " * 50_000, "x")]
    docs = spark.createDataFrame(rows, SCHEMA)
    tables, net = lm.Tables.from_counts(lm.count_ids(docs)), lm.Network(seed=4)
    got = sorted((r["doc_id"] or -1, r["n_tokens"], r["log_likelihood"]) for r in lm.score_documents(docs, net, tables).collect())
    want = []
    for d, text, _ in rows:
        ids, total = lm.token_ids(text).tolist(), 0.0
        if len(ids) < 1000:
            for i, t in enumerate(ids):
                near = [tables.context[ids[i + o]] if 0 <= i + o < len(ids) else lm.PAD for o in lm.OFFSETS]
                h = np.tanh(net.bias + sum(net.rows[o][c] for o, c in enumerate(near)))
                z = h @ net.out + net.out_bias
                total += z[tables.klass[t]] - np.log(np.exp(z).sum()) + tables.log_share[t]
        want.append((d or -1, len(ids), total))
    for g, w in zip(got, sorted(want), strict=True):
        assert g[:2] == w[:2] and (w[1] > 1000 or abs(g[2] - w[2]) < 1e-3 * max(1, abs(w[2])))


def test_probabilities_sum_to_one():
    counts = np.random.default_rng(1).integers(0, 100, lm.VOCABULARY)
    tables = lm.Tables.from_counts(counts)
    share = np.bincount(tables.klass, np.exp(tables.log_share.astype(float)), lm.CLASSES)
    assert np.allclose(share, 1, atol=1e-3)
    logp = lm.Network().forward(np.array([[1, 2, 3, 4]]))[1]
    assert abs(np.exp(logp).sum() - 1) < 1e-5


def test_counts_cover_all_documents_and_empty_table(spark):
    rows = corpus(5, 30)
    docs = spark.createDataFrame(rows, SCHEMA)
    assert lm.count_ids(docs).sum() == sum(len(t.split()) for _, t, _ in rows)
    none = docs.where(F.lit(False))
    net, tables = lm.fit(none)
    assert lm.score_documents(none, net, tables).count() == 0


def test_neighbours_tell_tokens_of_one_class_apart(spark):
    net, tables = lm.fit(spark.createDataFrame(corpus(1, 1500), SCHEMA).repartition(3))

    def middle(i, j):
        """Log probability of b_j between a_i and c_i."""
        tokens, context = lm.windows([np.concatenate([lm.token_ids(w) for w in (f"a{i}", f"b{j}", f"c{i}")])], tables)
        h, z = net.forward(context[1:2])
        return z[0, tables.klass[tokens[1]]] + tables.log_share[tokens[1]] + net.within(h, tokens[1:2], tables)[0]

    klass = [tables.klass[lm.token_ids(f"b{i}")[0]] for i in range(40)]
    pairs = [(i, j) for i in range(40) for j in range(i) if klass[i] == klass[j]]
    # what classes and counts say cancels out of these sums: only the order within the class is left
    better = np.array([middle(i, i) - middle(i, j) + middle(j, j) - middle(j, i) for i, j in pairs])
    assert len(better) >= 5 and (better > 0.5).mean() > 0.9
    net.nodes[:] = 0
    assert all(abs(middle(i, i) - middle(i, j) + middle(j, j) - middle(j, i)) < 1e-3 for i, j in pairs)


def test_tokens_sum_to_one_in_any_context():
    tables = lm.Tables.from_counts(np.random.default_rng(1).integers(0, 3, lm.VOCABULARY))
    net = lm.Network()
    net.nodes += np.random.default_rng(2).normal(0, 0.5, net.nodes.shape).astype(np.float32)
    h, z = net.forward(np.array([[1, 2, 3, 4]]))
    ids = np.arange(lm.VOCABULARY)
    more = net.within(np.broadcast_to(h, (len(ids), lm.HIDDEN)), ids, tables)
    assert abs(np.exp(z[0, tables.klass] + tables.log_share + more).sum() - 1) < 1e-3


def test_shares_and_picked_are_the_plain_softmax():
    z = np.random.default_rng(3).normal(0, 5, (50, 7)).astype(np.float32)
    z[0, 0] = 100  # cut at 60
    cut = np.minimum(z.astype(float), 60)
    want = np.exp(cut) / np.exp(cut).sum(axis=1, keepdims=True)
    column = np.arange(50) % 7
    assert np.allclose(lm.shares(z.copy()), want, rtol=1e-4, atol=1e-30)
    assert np.allclose(lm.picked(z.copy(), column), np.log(want[np.arange(50), column]), atol=1e-4)


def test_a_step_is_that_of_a_loop_over_tokens():
    """One step from fresh weights against gradients summed token by token in double precision."""
    rng = np.random.default_rng(5)
    tables = lm.Tables.from_counts(np.bincount(rng.integers(0, 5000, 20_000), minlength=lm.VOCABULARY).astype(float))
    tokens, context = lm.windows([rng.integers(0, 5000, 150)], tables)
    net, plain = lm.Network(seed=2), lm.Network(seed=2)
    net.nodes += rng.normal(0, 0.3, net.nodes.shape).astype(np.float32)
    plain.nodes[:] = net.nodes
    trainer = lm.Trainer(net)
    trainer.step(context, tokens, tables)
    sums = {k: np.zeros(getattr(plain, k).shape) for k in ("rows", "bias", "out", "out_bias", "nodes")}
    soft = lambda z: np.exp(z) / np.exp(z).sum()
    for t, near in zip(tokens, context, strict=True):
        h, c = np.tanh(plain.bias + sum(plain.rows[o][i] for o, i in enumerate(near)).astype(float)), tables.klass[t]
        d = soft(h @ plain.out + plain.out_bias)
        d[c] -= 1
        back = plain.out @ d
        if tables.bias[c, 1] > -1e8:
            e = soft(h @ plain.nodes[c] + tables.bias[c])
            e[tables.group[t]] -= 1
            back = back + plain.nodes[c] @ e
            sums["nodes"][c] += np.outer(h, e)
        back = back * (1 - h * h)
        sums["out"] += np.outer(h, d)
        sums["out_bias"] += d
        sums["bias"] += back
        for o, i in enumerate(near):
            sums["rows"][o, i] += back
    n, rate = len(tokens), trainer.rate
    for k, start in (("bias", 1e-6), ("out", 1e-6), ("out_bias", 1e-6), ("nodes", 1e-7)):
        g = sums[k] / n
        assert np.allclose(getattr(net, k), getattr(plain, k) - rate * g / np.sqrt(start + g * g), atol=2e-3), k
    g = sums["rows"] / n
    assert np.allclose(net.rows, plain.rows - rate * g / np.sqrt(1e-6 + (g * g).mean(axis=2, keepdims=True)), atol=2e-3)
