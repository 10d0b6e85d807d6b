"""Scores, levels and whole predictions (D-1 to D-3, D-9, D-10)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .decision import Policy, decide
from .evidence import evidence
from .validate import scoring_error

#: Default risk thresholds.
THRESHOLDS = {"MEDIUM": 0.60, "HIGH": 0.80, "CRITICAL": 0.95}


def check_thresholds(t: dict[str, float]) -> dict[str, float]:
    """D-3: 0 < MEDIUM < HIGH < CRITICAL <= 1."""
    try:
        m, h, c = (float(t[k]) for k in ("MEDIUM", "HIGH", "CRITICAL"))
    except (KeyError, TypeError, ValueError) as e:
        raise ValueError(f"threshold missing or no number: {e}") from None
    if not (all(map(math.isfinite, (m, h, c))) and 0 < m < h < c <= 1):
        raise ValueError("thresholds must rise from above 0 to at most 1")
    return {"MEDIUM": m, "HIGH": h, "CRITICAL": c}


def score_logistic(coefficients: list[float], intercept: float, features: list[Column]) -> Column:
    """Logistic score as one expression, in single precision at the end."""
    z = F.lit(float(intercept))
    for w, x in zip(coefficients, features, strict=True):
        z = z + F.lit(float(w)) * x.cast("double")
    return (F.lit(1.0) / (F.lit(1.0) + F.exp(-z))).cast("float")


def risk_level(score: Column, thresholds: dict[str, float] | None = None) -> Column:
    t = check_thresholds(thresholds or THRESHOLDS)
    return F.when(score >= t["CRITICAL"], "CRITICAL").when(score >= t["HIGH"], "HIGH").when(score >= t["MEDIUM"], "MEDIUM").otherwise("LOW")


def score_model(df: DataFrame, model, features: str = "features") -> DataFrame:
    """D-1: probability of class 1 by a fitted MLlib classifier; ``features`` is an array column."""
    from pyspark.ml.functions import array_to_vector, vector_to_array

    vec = df.withColumn("_vec", array_to_vector(F.col(features)))
    model = model.copy({model.getParam("featuresCol"): "_vec"}) if model.hasParam("featuresCol") else model
    out = model.transform(vec)
    drop = [c for c in ("_vec", "rawPrediction", "probability", "prediction") if c not in df.columns]
    return out.withColumn("risk_score", vector_to_array("probability")[1].cast("float")).drop(*drop)


def predict(df: DataFrame, score: Column, policy: Policy, model_version: str, n_features: int, thresholds: dict[str, float] | None = None, named: dict[str, Column] | None = None, policy_z: str = "top2") -> DataFrame:
    """D-9: status, score, level, evidence and decision of every request row.

    ``df`` has op, match_id, player_id and features. Rows that cannot be scored
    have status UNAVAILABLE, score 0, no decision and the reason in ``error``.
    ``named`` gives the evidence features by name (none: no evidence); without
    it the array's first six values are taken in order.
    """
    error = scoring_error(n_features)
    ok = df.withColumn("error", error)
    ok = ok.withColumn("_s", F.when(F.col("error").isNull(), score))
    bad_score = F.col("error").isNull() & (F.col("_s").isNull() | F.isnan("_s") | (F.col("_s") < 0) | (F.col("_s") > 1))
    ok = ok.withColumn("error", F.when(bad_score, F.lit("score_out_of_range")).otherwise(F.col("error")))
    served = F.col("error").isNull()
    feats = F.col("features")
    items = evidence(named) if named is not None else evidence(positional=feats)
    out = ok.withColumn("risk_score", F.when(served, F.col("_s")).otherwise(F.lit(0.0)).cast("float")).drop("_s")
    out = out.withColumn("evidence", F.when(served, items))
    out = out.withColumn("decision", F.when(served, decide(F.col("risk_score"), F.col("evidence"), policy, feats, policy_z)))
    return out.select(
        F.when(served, "OK").otherwise("UNAVAILABLE").alias("status"), "match_id", "player_id", "risk_score", F.when(served, risk_level(F.col("risk_score"), thresholds)).alias("risk_level"),
        F.lit(model_version).alias("model_version"), "evidence", "decision", "error",
    )


def to_contract_prediction(preds: DataFrame, scored_at: Column | None = None, medium: float = 2.0, high: float = 4.0) -> DataFrame:
    """D-10: the contract's form; the cut-offs of a contribution's size are parameters."""
    size = lambda z: F.when(z >= high, "high").when(z >= medium, "medium").otherwise("low")
    items = F.transform("evidence", lambda e: F.struct(e["feature"].alias("feature"), e["value"].alias("value"), e["lobby_avg"].alias("reference_value"), size(e["z_score"]).alias("contribution")))
    return preds.where("status = 'OK'").select(
        F.sha2(F.concat_ws("|", "match_id", "player_id", "model_version"), 256).alias("prediction_id"), "match_id", "player_id", "model_version", "risk_score", "risk_level",
        items.alias("evidence"), (F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX") if scored_at is None else scored_at).alias("scored_at"),
    )
