"""The forest's scores by batches of rows, against a loop over rows and trees."""

import math

import pytest
from pyspark.sql import functions as F

from matchguard.operators import ml


def test_scores_are_those_of_a_loop_and_rows_go_in_batches(spark):
    forest = {"cols": ["a", "b"], "sample": 4, "limit": 2, "offset": 0.0, "trees": [
        {"f": [0, -1, 1, -1, -1, -1, -1], "cut": [1.0, 0.0, 5.0, 0.0, 0.0, 0.0, 0.0], "length": [0.0, 1.0, 0.0, 0.0, 0.0, 2.0, 2.5]},
        {"f": [-1] * 7, "cut": [0.0] * 7, "length": [1.5] + [0.0] * 6}]}
    rows = [(1, 0.5, 9.0), (2, 1.0, 4.0), (3, 1.0, 5.0), (4, None, 1.0), (5, float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "id int, a double, b double")
    scored = ml.isolation_forest_score(df, forest)
    assert "MapInArrow" in scored._jdf.queryExecution().executedPlan().toString()  # 800 interpreted steps a row before
    expected = 2 * (math.log(3) + 0.5772156649015329) - 2 * 3 / 4
    want = {i: -(2.0 ** (-(path + 1.5) / 2 / expected)) for i, path in ((1, 1.0), (2, 2.0), (3, 2.5))}
    got = {r["id"]: r["anomaly_score"] for r in scored.collect()}
    assert got.keys() == want.keys() and all(got[i] == pytest.approx(want[i], abs=1e-12) for i in want)
    assert scored.columns == ["id", "a", "b", "anomaly_score"]


def test_fitting_needs_rows(spark):
    with pytest.raises(ValueError):
        ml.isolation_forest_fit(spark.range(3).select(F.lit(None).cast("double").alias("a")), ["a"])
