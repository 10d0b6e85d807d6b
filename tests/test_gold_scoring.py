"""Gold features, scoring, evidence and policy: the known vectors."""

import math

import pytest
from pyspark.sql import functions as F

from matchguard import schemas as S
from matchguard.operators import decision, evidence, features, gold, quality, reports, scoring, silver

KILLS = "match_id string, killer_name string, victim_name string, event_time_seconds double, killer_position_x double, killer_position_y double, victim_position_x double, victim_position_y double, weapon string"
ROWS = [("m1", "A", "B", 100.0, 0.0, 0.0, 3.0, 4.0, "M416"), ("m1", "A", "B", 105.0, 0.0, 0.0, 6.0, 8.0, "M416"), ("m1", "A", "B", 130.0, 0.0, 0.0, 0.0, 0.0, ""), ("m1", "A", "B", None, None, None, None, None, "AKM"), ("m1", "C", "A", 50.0, 1.0, 1.0, 4.0, 5.0, "M416")]


def test_gold_of_a_hand_computed_match(spark):
    k = spark.createDataFrame(ROWS, KILLS)
    pm = silver.participants(k).withColumn("kills", F.lit(0).cast("bigint"))
    got = {r["player_id"]: tuple(r[c] for c in S.FEATURES) for r in gold.gold_features(pm, k).collect()}
    assert got == {"A": (4, 5.0, 5.0, 1, 2), "B": (0, None, None, 0, 0), "C": (1, None, 5.0, 0, 1)}


def test_gold_plan_shuffles_kills_once_and_has_no_global_window(spark):
    k = spark.createDataFrame(ROWS, KILLS)
    plan = gold.kill_features(k)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SinglePartition" not in plan


def test_identities(spark):
    b = spark.createDataFrame([("e1", S.OP_KILL_RAW, "m", "h", "A", "B"), ("e2", S.OP_KILL_RAW, "m", "h", None, "B"), ("e3", S.OP_MATCH_SUMMARY, "m", "p", "p", None)], "event_id string, op string, match_id string, player_id string, killer_name string, victim_name string")
    full = b.select(*(F.col(f.name) if f.name in b.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in S.BRONZE.fields)).withColumn("kills", F.when(F.col("event_id") == "e3", 7).cast("bigint")).withColumn("damage_dealt", F.when(F.col("event_id") == "e3", float("nan")))
    assert [r["killer_name"] for r in silver.to_silver_kill_events(full, "reference").orderBy("event_id").collect()] == ["A", "h", "p"]
    assert [r["killer_name"] for r in silver.to_silver_kill_events(full).collect()] == ["A"]
    ref = {r["player_id"]: (r["kills"], r["damage_dealt"]) for r in silver.player_match(full, "reference").collect()}
    assert ref == {"h": (0, 0.0), "p": (7, 0.0), "B": (0, 0.0)}
    hashed = silver.canonical_identity(full).where("event_id = 'e1'").head()
    assert len(hashed["killer_name"]) == 64


def test_rate_features_and_edges(spark):
    df = spark.createDataFrame([("m", "a", 0, 0, 100.0, 1.0, 2.0, 3.0, 0.0), ("m", "b", 4, 2, 200.0, 20000.0, 0.0, 0.0, 60.0)], "match_id string, player_id string, kills long, headshot_kills long, damage_dealt double, walk_distance double, ride_distance double, swim_distance double, survival_duration double")
    a, b = features.rate_features(df).orderBy("player_id").collect()
    assert (a["kills_per_minute"], a["headshot_ratio"], a["damage_per_kill"], a["total_distance"]) == (0.0, 0.0, 100.0, 6.0) and math.isclose(a["damage_per_minute"], 6000.0)
    assert (b["kills_per_minute"], b["headshot_ratio"], b["damage_per_kill"]) == (4.0, 0.5, 50.0)
    assert [r["speed_anomaly"] for r in features.speed_anomaly(df).orderBy("player_id").collect()] == [False, True]
    rel = features.lobby_relative(df, scaled=False).orderBy("player_id").collect()
    assert [r["performance_vs_lobby"] for r in rel] == [-50.0, 50.0]


COEF, INTERCEPT = [0.05966074392199516, -0.0767066702246666, -0.16193631291389465, 0.025568891316652298, 0.008522963151335716], 4.569425582885742


def test_score_vectors(spark):
    df = spark.createDataFrame([([1.0, 10.0, 20.0, 2.0, 3.0],), ([8.0, 1.0, 1.0, 5.0, 4.0],)], "x array<double>")
    s = scoring.score_logistic(COEF, INTERCEPT, [F.col("x")[i] for i in range(5)])
    t = {"MEDIUM": 0.3, "HIGH": 0.6, "CRITICAL": 0.9}
    a, b = df.select(s.alias("s"), scoring.risk_level(s, t).alias("l")).collect()
    assert abs(a["s"] - 0.6681878) < 1e-6 and abs(b["s"] - 0.99310476) < 1e-6 and (a["l"], b["l"]) == ("HIGH", "CRITICAL")
    for bad in ({"MEDIUM": 0.3}, {"MEDIUM": 0.6, "HIGH": 0.3, "CRITICAL": 0.9}, {"MEDIUM": 0.1, "HIGH": 0.3, "CRITICAL": 1.1}, {"MEDIUM": float("nan"), "HIGH": 0.3, "CRITICAL": 1}):
        with pytest.raises(ValueError):
            scoring.check_thresholds(bad)


@pytest.mark.parametrize(("x", "want"), [
    ([1.50, 750.0, 0.833, 500.0, 250.0, 800.0], [("kills_per_minute", 11.4), ("damage_per_minute", 9.4)]),
    ([0.10, 100.0, 0.15, 80.0, 140.0, 180.0], []),
    ([0.15, 120.0, 0.95, 100.0, 150.0, 200.0], [("headshot_ratio", 6.5)]),
    ([0.15, 120.0, 0.18, 500.0, 250.0, 200.0], [("damage_per_kill", 9.0), ("movement_per_minute", 1.7)]),
    ([0.15, 120.0, 0.18, 500.0, 250.0, 800.0], [("damage_per_kill", 9.0), ("performance_versus_lobby", 5.1)]),
    ([0.15, 120.0, 0.18, 100.0, 400.0], [("movement_per_minute", 4.2)]),
])
def test_evidence_vectors(spark, x, want):
    e = spark.createDataFrame([(x,)], "x array<double>").select(evidence.evidence(positional=F.col("x")).alias("e")).head()["e"]
    assert [(i["feature"], round(i["z_score"], 1)) for i in e] == want


def test_evidence_by_name_equals_by_position(spark):
    df = spark.createDataFrame([([0.15, 120.0, 0.18, 500.0, 400.0, 200.0],)], "x array<double>")
    named = {n: F.col("x")[i] for i, n in enumerate(["kills_per_minute", "damage_per_minute", "headshot_ratio", "damage_per_kill", "movement_per_minute", "performance_versus_lobby"])}
    a, b = df.select(evidence.evidence(named).alias("a"), evidence.evidence(positional=F.col("x")).alias("b")).head()
    assert a == b and [i["feature"] for i in a] == ["damage_per_kill", "movement_per_minute"]
    assert a[0]["reason"] == "damage_per_kill 500.00 against 100.00 in the lobby (+9.0 sigma)"


@pytest.mark.parametrize(("score", "x", "want"), [
    (0.15, [0.10, 100.0, 0.15, 80.0, 140.0, 180.0], ("CLEAR", "LOW", "auto_clear")),
    (0.45, [0.10, 100.0, 0.15, 80.0, 140.0, 180.0], ("WATCHLIST", "MEDIUM", "watchlist_monitoring")),
    (0.75, [0.10, 100.0, 0.15, 80.0, 140.0, 180.0], ("ESCALATE_TO_MODERATOR", "HIGH", "escalate_human_review")),
    (0.90, [0.15, 120.0, 0.95, 100.0, 150.0, 200.0], ("SUSPEND_ACCOUNT", "URGENT", "auto_suspend_aimbot")),
    (0.90, [0.10, 100.0, 0.15, 80.0, 140.0, 180.0], ("PERMANENT_BAN", "CRITICAL", "critical_permanent_ban")),
    (0.15, [0.0] * 9 + [0.95, 0.0], ("PERMANENT_BAN", "CRITICAL", "heuristic_teleport_hack")),
    (0.15, [2.0] + [0.0] * 7 + [150.0, 0.0], ("PERMANENT_BAN", "CRITICAL", "heuristic_burst_aimbot")),
    (0.15, [0.0] * 10 + [5.0], ("PERMANENT_BAN", "CRITICAL", "heuristic_headshot_streak")),
])
def test_decision_vectors(spark, score, x, want):
    df = spark.createDataFrame([(score, x)], "s double, x array<double>")
    d = df.select(decision.decide(F.col("s"), evidence.evidence(positional=F.col("x")), decision.FIVE_RULES, F.col("x")).alias("d")).head()["d"]
    assert (d["action"], d["priority"], d["policy_rule"]) == want


def test_policies(tmp_path):
    (tmp_path / "p.yml").write_text("version: v9\nrules:\n  - {name: a, min_score: 0.5, action: X, priority: Y}\n")
    p = decision.load_policy(str(tmp_path / "p.yml"))
    assert p.version == "v9" and p.rules[0].max_score == 1.01 and p.default_action == "CLEAR"
    for bad in ({"version": "", "rules": [1]}, {"version": "v", "rules": []}, {"version": "v", "rules": [{"name": "", "action": "", "priority": ""}]}, {"version": "v", "rules": [{"name": "a", "min_score": 0.5, "max_score": 0.5, "action": "", "priority": ""}]}, {"version": "v", "rules": [{"name": "a", "max_score": 1.2, "action": "", "priority": ""}]}):
        with pytest.raises(ValueError):
            decision.make_policy(bad)
    with pytest.raises(FileNotFoundError):
        decision.load_policy(str(tmp_path / "none.yml"))


def test_predictions_and_contract(spark):
    req = spark.createDataFrame([("predict", "m", "p", [1.0, 10.0, 20.0, 2.0, 3.0]), ("predict", "m", "q", [1.0])], "op string, match_id string, player_id string, features array<double>")
    s = scoring.score_logistic(COEF, INTERCEPT, [F.get("features", F.lit(i)) for i in range(5)])
    rows = {r["player_id"]: r for r in scoring.predict(req, s, decision.FIVE_RULES, "v1", 5).collect()}
    assert rows["p"]["status"] == "OK" and rows["p"]["risk_level"] == "MEDIUM" and rows["p"]["decision"]["policy_rule"] == "escalate_human_review"
    assert rows["q"]["status"] == "UNAVAILABLE" and rows["q"]["risk_score"] == 0 and rows["q"]["decision"] is None and rows["q"]["error"] == "feature_count_mismatch"
    assert scoring.to_contract_prediction(scoring.predict(req, s, decision.FIVE_RULES, "v1", 5)).count() == 1


def test_describe_vector(spark):
    d = reports.describe_features(spark.createDataFrame([(x,) for x in (0, 1, 5, 12, 25)], "kills int"), ["kills"]).head()
    assert [round(d[c], 2) for c in ("mean", "median", "min", "max", "sd", "p95", "p99")] == [8.6, 5.0, 0.0, 25.0, 10.31, 22.4, 24.48]


def test_high_water_mark_and_reports(spark):
    ids = spark.createDataFrame([(i,) for i in (1, 2, 3, 5)], "record_index long")
    assert reports.contiguous_high_water_mark(ids, 0).head()[0] == 3 and reports.contiguous_high_water_mark(ids, 10).head()[0] == 10
    rejects = spark.createDataFrame([(["a", "b"],), (["a"],)], "reasons array<string>")
    assert {r["reason"]: (r["records"], float(r["percent"])) for r in reports.invalid_reason_breakdown(rejects).collect()} == {"a": (2, 100.0), "b": (1, 50.0)}
    preds = spark.createDataFrame([("m", "X", 1.0, "CRITICAL"), ("m", "Y", 0.12, "LOW")], "match_id string, player_id string, risk_score double, risk_level string")
    assert {(r["bin"], r["risk_level"]) for r in reports.risk_histogram(preds).collect()} == {(9, "CRITICAL"), (1, "LOW")}
    assert reports.rank_predictions(preds, n=1).head()["player_id"] == "X" and reports.filter_predictions(preds, "LOW").count() == 1


def test_invariants_report_each_break(spark):
    b = spark.createDataFrame([(S.OP_KILL_RAW, "k")], "op string, killer_name string")
    kills = spark.createDataFrame([("player_suspect_1", "v"), ("k", "v")], "killer_name string, victim_name string")
    pm = spark.createDataFrame([("m", "p"), ("m", "p")], "match_id string, player_id string")
    got = {r["invariant"]: r["violations"] for r in quality.verify_invariants(b, kills, pm, pm.limit(0)).collect()}
    assert got["I4_gold_not_empty"] == 1 and got["I5_kill_rows_equal_bronze"] == 1 and got["I6_no_duplicate_player_match"] == 2 and got["I7_no_synthetic_kill_rows"] == 1 and got["I1_bronze_not_empty"] == 0
