"""A level's best splits by sums on the driver and by a shuffle, and what a level costs."""

import random

from pyspark.sql import functions as F

from matchguard.operators import boosting


def test_both_ways_of_folding_find_the_same_splits_and_a_small_level_has_no_shuffle(spark, monkeypatch):
    draw = random.Random(5)
    rows = [([draw.randrange(6), draw.randrange(4)], draw.randrange(1, 9), 0, draw.uniform(-1, 1)) for _ in range(300)]
    rows = [(b, n, min(n, b[0]), m) for b, n, _, m in rows]
    state = spark.createDataFrame(rows, "b array<int>, n long, pos long, m double").repartition(3).persist()
    edges = [[float(i) for i in range(5)], [float(i) for i in range(3)]]
    tree = {"f": [0, -2, -2], "at": [2, 0, 0], "cut": [2.0, 0.0, 0.0], "left": [1, 0, 0], "value": [0.0] * 3}
    one = boosting._splits(state, edges, tree, 1, 1.0, 1.0, 3)
    monkeypatch.setattr(boosting, "_best", None)  # the other way needs no sums on the driver
    two = boosting._splits(state, edges, tree, 1, 1.0, 1.0, 3, most=0)
    shown = lambda rs: sorted((r["node"], round(r["gt"], 9), round(r["ht"], 9), r["s"]["f"], r["s"]["bin"], round(r["s"]["gl"], 9)) for r in rs)
    assert len(one) == 2 and shown(one) == shown(two)
    cells = state.select("b", F.col("n").cast("double"), F.col("pos").cast("double"), "m").mapInArrow(boosting._sums(tree, 1, 2, 7), "node int, f int, bin int, g double, h double")
    assert cells.count() <= 3 * 2 * 10 and "Exchange" not in cells._jdf.queryExecution().executedPlan().toString().split("InMemoryTableScan")[0]
    state.unpersist()
