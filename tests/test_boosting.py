"""The histogram learner against a plain one over rows."""

import numpy as np
from pyspark.sql import functions as F

from matchguard.operators import boosting


def plain(x, y, rounds, depth, bins=256, rate=0.3, share=1.0, least=1.0):
    """Boosting of the same bins by loops; returns the probability of every row."""
    codes = np.zeros(x.shape, int)
    for f in range(x.shape[1]):
        v = x[:, f]
        known = np.sort(v[~np.isnan(v)])
        held = np.unique(known)
        if len(held) > bins:
            place = {a: (np.searchsorted(known, a, "right") - 1) * bins // len(known) for a in held}
            firsts = {}
            for a in held:
                firsts.setdefault(place[a], a)
            held = np.array(sorted(firsts.values()))
        edges = held[1:]
        codes[:, f] = [len(edges) if np.isnan(a) else np.sum(edges <= a) for a in v]
    m = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-m))
        g, h, leaf = p - y, p * (1 - p), [np.arange(len(y))]
        for _ in range(depth):
            grown = []
            for rows in leaf:
                best, at = 1e-6, None
                gt, ht = g[rows].sum(), h[rows].sum()
                for f in range(x.shape[1]):
                    for b in np.unique(codes[rows, f]):
                        left = rows[codes[rows, f] <= b]
                        gl, hl = g[left].sum(), h[left].sum()
                        if hl < least or ht - hl < least:
                            continue
                        gain = round(gl**2 / (hl + share) + (gt - gl) ** 2 / (ht - hl + share) - gt**2 / (ht + share), 9)
                        if gain > best:
                            best, at = gain, (f, b)
                if at is None:
                    grown.append(rows)
                else:
                    grown += [rows[codes[rows, at[0]] <= at[1]], rows[codes[rows, at[0]] > at[1]]]
            leaf = grown
        for rows in leaf:
            m[rows] -= rate * g[rows].sum() / (h[rows].sum() + share)
    return 1 / (1 + np.exp(-m))


def table(spark, seed=5, n=260):
    rng = np.random.default_rng(seed)
    a, b, c = rng.normal(size=n).round(2), rng.integers(0, 4, n).astype(float), rng.exponential(size=n)
    y = ((a + b > 1.5) ^ (c > 1.2) ^ (rng.random(n) < 0.05)).astype(int)
    a[::17] = np.nan
    rows = [(i, None if np.isnan(u) and i % 2 else float(u), float(v), float(w), int(t)) for i, (u, v, w, t) in enumerate(zip(a, b, c, y))]
    rows += [(1000 + i, *r[1:]) for i, r in enumerate(rows[:40])] * 2  # repeated rows
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y int"), rows


def test_scores_equal_a_plain_learner(spark):
    df, rows = table(spark)
    x = np.array([[np.nan if v is None else v for v in r[1:4]] for r in rows], float)
    y = np.array([r[4] for r in rows], float)
    for bins, rounds, depth, written in ((256, 4, 4, 10), (12, 3, 3, 2)):
        model = boosting.fit(df, ["a", "b", "c"], "y", rounds=rounds, depth=depth, bins=bins, written=written)
        got = boosting.score(model, df).select("id", "risk_score").collect()
        want = {r[0]: p for r, p in zip(rows, plain(x, y, rounds, depth, bins))}
        assert len(got) == len(rows) and max(abs(r["risk_score"] - want[r["id"]]) for r in got) < 1e-6


def test_bins_hold_equal_values_together_and_few_values_apart(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 600, 7.0).otherwise(F.col("id").cast("double")).alias("hot"), (F.col("id") % 3).cast("double").alias("few"), F.lit(None).cast("double").alias("none"))
    hot, few, none = boosting.bin_edges(df, ["hot", "few", "none"], 10)
    assert few == [1.0, 2.0] and none == [] and hot == [600.0, 700.0, 800.0, 900.0]
    x = spark.createDataFrame([(None,), (float("nan"),), (-1.0,), (0.0,), (1.0,), (1.5,), (9.0,)], "x double")
    assert [r[0] for r in x.select(boosting.bin_of(F.col("x"), few)).collect()] == [2, 2, 0, 0, 1, 1, 2]


def test_odd_tables_and_round_trip(spark, tmp_path):
    df, _ = table(spark, n=60)
    model = boosting.fit(df, ["a", "b", "c"], "y", rounds=2, depth=3)
    path = f"file://{tmp_path}/model"
    model.save(spark, path)
    assert boosting.BoostedTrees.load(spark, path) == model
    empty = boosting.fit(df.where("false"), ["a"], "y", rounds=2, depth=2)
    assert empty.trees == [] and boosting.score(empty, df).where("risk_score < 0.001").count() == df.count()
    one = boosting.fit(df.withColumn("y", F.lit(1)), ["a", "b"], "y", rounds=2, depth=2)
    assert boosting.score(one, df).where("risk_score > 0.99").count() == df.count()
    root = boosting.fit(df, ["a"], "y", rounds=1, depth=0)
    assert [t["f"] for t in root.trees] == [[-1]]
    odd = df.withColumnRenamed("a", "a b").withColumns({"n": F.lit("x"), "m": F.lit("y"), "node": F.lit(1)})
    kept = boosting.score(boosting.fit(odd, ["a b", "b"], "y", rounds=1, depth=2), odd)
    assert kept.count() == df.count() and set(odd.columns) < set(kept.columns)


def test_a_level_reads_cells_and_one_row_a_node_comes_back(spark):
    df, _ = table(spark)
    model = boosting.fit(df, ["a", "b", "c"], "y", rounds=1, depth=3)
    plan = boosting.score(model, df)._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_training_tells_the_scores_of_its_rows(spark):
    """F2: the same scores and metrics as the model's walk over the rows, without one."""
    from matchguard.operators import ml

    df, rows = table(spark)
    model, told = boosting.fit_scored(df, ["a", "b", "c"], "y", rounds=3, depth=3)
    assert model == boosting.fit(df, ["a", "b", "c"], "y", rounds=3, depth=3)
    walked = boosting.score(model, df).select(F.col("risk_score").alias("score"), F.col("y").alias("label"))
    count = lambda rs: {(round(r["score"], 6), r["label"]): r["n"] for r in rs}
    by = [F.round(F.col("score").cast("double"), 6).alias("score"), "label"]
    assert count(told.groupBy(*by).agg(F.sum("weight").alias("n")).collect()) == count(walked.groupBy(*by).agg(F.count("*").alias("n")).collect())
    one, two = ml.classification_metrics(told, weight="weight").head(), ml.classification_metrics(walked).head()
    assert one["rows"] == two["rows"] == len(rows) and all(abs(one[k] - two[k]) < 1e-9 for k in ("precision", "recall", "f1", "average_precision"))


def test_levels_read_chunks_and_not_vectors(spark, monkeypatch):
    """a row of the table that every level reads holds many vectors."""
    df = spark.range(3000).select((F.col("id") * 7919 % 3000).cast("double").alias("a"), (F.col("id") % 50).cast("double").alias("b"), ((F.col("id") * 7919 % 3000 > 2000) & (F.col("id") % 50 < 20)).cast("int").alias("y"))
    seen, grow = [], boosting._grow
    monkeypatch.setattr(boosting, "_grow", lambda state, *rest: seen.append(state.count()) or grow(state, *rest))
    boosting.fit(df, ["a", "b"], "y", rounds=2, depth=3)
    assert max(seen) <= 8


def test_chunks_are_cut_and_read_alike(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(boosting, "_CHUNK", 7)
    draw = np.random.default_rng(3)
    for bins in (5, 400):
        b, n = draw.integers(0, bins - 1, (40, 2)), draw.integers(1, 9, 40)
        rows = pa.RecordBatch.from_arrays([pa.array(b.tolist(), pa.list_(pa.int32())), pa.array(n), pa.array(n // 2)], names=["b", "n", "pos"])
        chunks = list(boosting._packed(2, bins)([rows.slice(0, 3), rows.slice(3)]))
        assert sum(c.column(3)[0].as_py() for c in chunks) == n.sum() and len(chunks) >= 6
        held = [v for c in chunks for v in boosting._vectors(pa.RecordBatch.from_arrays([*c.columns[:3], pa.array([None], pa.binary())], names=["b", "n", "pos", "m"]), 2, bins)]
        assert (np.concatenate([v[0] for v in held], axis=1).T == b).all() and (np.concatenate([v[2] for v in held]) == n // 2).all()
        assert all(len(v[1]) <= 7 and (v[3] == 0).all() for v in held)
