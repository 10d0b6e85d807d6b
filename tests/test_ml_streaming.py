"""Training, bundles and streams."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchguard import schemas as S
from matchguard.operators import decision, ml, validate
from matchguard.operators import bronze, reports
from matchguard.plans.queries import QUERIES
from matchguard.sources import lake, readers, sinks
from matchguard.streaming import pipeline

GOLD = "match_id string, player_id string, kills long, minimum_kill_interval_seconds double, median_kill_distance_coordinate_units double, short_kill_interval_count long, unique_weapons_used long, is_suspicious int"


def gold(spark, n=80, label=None):
    rng = np.random.default_rng(42)
    rows = [(f"match-{i // 8}", f"player-{i}", int(rng.integers(0, 12)), float(rng.uniform(0, 999)), float(rng.uniform(0, 500)), int(rng.integers(0, 6)), int(rng.integers(0, 8)), None if label is None else int(label(i))) for i in range(n)]
    return spark.createDataFrame(rows, GOLD)


def test_training_paths(spark):
    model, m = ml.train(gold(spark), trees=20, rounds=2, depth=2)
    assert m["mode"] == "unsupervised" and m["rows"] == 80 and 0 <= m["surrogate_f1"] <= 1
    _, m = ml.train(gold(spark, label=lambda i: i % 3 == 0), rounds=2, depth=2)
    assert m["mode"] == "supervised" and m["rows"] == 16
    with pytest.raises(ValueError):
        ml.train(gold(spark, 10))
    with pytest.raises(ValueError):
        ml.train(gold(spark, label=lambda i: 1), rounds=1)
    with pytest.raises(ValueError):
        validate.finite_features(gold(spark, 10))


def test_split_keeps_matches_whole(spark):
    train, test = ml.group_split(gold(spark))
    a, b = ({r[0] for r in d.select("match_id").distinct().collect()} for d in (train, test))
    assert not a & b and len(b) == 2 and len(a) == 8


def test_forest_finds_planted_outliers(spark):
    rng = np.random.default_rng(1)
    rows = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.normal(size=(600, 2)))] + [(1000 + i, 9.0 + i, -9.0 - i) for i in range(6)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    forest = ml.isolation_forest_fit(df, ["x", "y"], trees=50, contamination=0.02)
    assert len(forest["trees"]) == 50
    scored = {r["id"]: r["anomaly_score"] for r in ml.isolation_forest_score(df, forest).collect()}
    assert sorted(scored, key=scored.get)[:6] and set(sorted(scored, key=scored.get)[:6]) == {1000 + i for i in range(6)}
    assert 5 <= sum(v < 0 for v in scored.values()) <= 20
    labels = ml.pseudo_labels(spark.createDataFrame(list(scored.items()), "id long, anomaly_score double"), ["id"], share=0.01)
    assert {r["id"] for r in labels.where("pseudo_label = 1").collect()} == {1000 + i for i in range(6)}


def test_bundles(spark, tmp_path):
    root = f"file://{tmp_path}/models"
    model, metrics = ml.train(gold(spark, label=lambda i: i % 3 == 0), rounds=2, depth=2)
    version = ml.model_version("a" * 64, "b" * 64)
    assert version == ml.model_version("a" * 64, "b" * 64) and len(version) == 18
    path = ml.save_bundle(model, metrics, root, version)
    assert ml.save_bundle(model, metrics, root, version) == path
    with pytest.raises(ValueError):
        ml.save_bundle(model, metrics | {"f1": 2.0}, root, version)
    loaded, schema = ml.load_bundle(spark, path)
    assert schema["features"] == S.FEATURES
    assert ml.score_classifier(loaded, gold(spark)).where("risk_score between 0 and 1").count() == 80
    (tmp_path / f"models/versions/{version}/.metrics.json.crc").unlink(missing_ok=True)  # the local file system's own check
    (tmp_path / f"models/versions/{version}/metrics.json").write_text("{}")
    with pytest.raises(ValueError):
        ml.verify_bundle(spark, path)


def test_incremental_training_and_scoring_stream(spark, tmp_path):
    root, lake = f"file://{tmp_path}/models", str(tmp_path / "gold")
    gold(spark, label=lambda i: i % 3 == 0).write.parquet(lake)
    version = ml.train_incremental(spark, lake, root, rounds=2, depth=2)
    assert version and ml.train_incremental(spark, lake, root, rounds=2, depth=2) is None
    (tmp_path / "models/versions/v-zzz").mkdir()  # a broken candidate
    stream = spark.readStream.schema(spark.read.parquet(lake).schema).parquet(lake)
    pipeline.start_scoring(stream, root, decision.FIVE_RULES, str(tmp_path / "preds"), str(tmp_path / "cp")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "preds"))
    assert out.count() == 80 and out.where("status = 'OK'").count() == 80
    assert [r[0] for r in out.select("model_version").distinct().collect()] == [version]


def test_retries_back_off_then_report():
    waits, calls = [], []

    def fails():
        calls.append(1)
        raise RuntimeError("no")

    assert str(pipeline.with_retries(fails, 3, waits.append)) == "no" and len(calls) == 3 and waits == [1.0, 2.0]
    assert pipeline.with_retries(lambda: None, 3, waits.append) is None


def test_metrics_against_a_loop(spark):
    rng = np.random.default_rng(3)
    s, y = rng.integers(0, 50, 400) / 50, rng.integers(0, 2, 400)
    m = ml.classification_metrics(spark.createDataFrame([(float(a), int(b)) for a, b in zip(s, y)], "score double, label int")).head()
    cuts, ap, last = sorted(set(s.tolist()), reverse=True), 0.0, 0.0
    for c in cuts:
        tp, n = int(y[s >= c].sum()), int((s >= c).sum())
        ap, last = ap + (tp / y.sum() - last) * tp / n, tp / y.sum()
    tp, fp, fn = int(y[s >= 0.5].sum()), int((1 - y[s >= 0.5]).sum()), int(y[s < 0.5].sum())
    assert abs(m["average_precision"] - ap) < 1e-9 and abs(m["f1"] - 2 * tp / (2 * tp + fp + fn)) < 1e-9 and m["rows"] == 400
    none = ml.classification_metrics(spark.createDataFrame([], "score double, label int")).head()
    assert (none["precision"], none["average_precision"], none["rows"]) == (0.0, 0.0, 0)


def test_stream_equals_batch(spark):
    rows = {r["side"]: r["rows"] for r in QUERIES["stream_equals_batch"](spark, "/root/testdata/sf0.001").collect()}
    assert set(rows) == {"streamed"} and rows["streamed"] > 0


def test_rejects_never_block_and_batches_repeat_without_traces(spark, tmp_path):
    from test_normalize_validate import BASE, KILL, messages

    bad = BASE | {"payload": BASE["payload"] | {"kills": 0}}
    m = messages(spark, [BASE, BASE, KILL, bad, b"\xff"]).withColumn("timestamp", F.current_timestamp())
    root = f"file://{tmp_path}/lake"
    first = pipeline.process_batch(m, root)
    assert first == pipeline.process_batch(m, root)
    manifest = readers.read_manifests(spark, f"{root}/manifests").collect()
    assert [(m["total_records_read"], m["valid_records_count"], m["invalid_records_count"], m["duplicate_records_count"]) for m in manifest] == [(5, 3, 1, 2)]
    assert len(manifest[0]["checksum_sha256"]) == 64 and manifest[0]["partition_offsets"].keys() == {2}
    assert spark.read.parquet(f"{root}/bronze/events").count() == 1
    assert spark.read.json(f"{root}/bronze/malformed").count() == 1 and spark.read.json(f"{root}/bronze/invalid").count() == 1
    only = messages(spark, [b"\xff"]).withColumn("timestamp", F.current_timestamp())
    assert pipeline.process_batch(only, f"file://{tmp_path}/other")


def test_a_batch_repeated_after_midnight_leaves_one_of_each(spark, tmp_path, monkeypatch):
    from test_normalize_validate import BASE, KILL, messages

    bad = BASE | {"event_id": "short"}
    m = messages(spark, [BASE, KILL, bad, b"\xff"]).withColumn("timestamp", F.lit("2026-07-28 23:59:59").cast("timestamp"))
    root = f"file://{tmp_path}/lake"
    pipeline.process_batch(m, root)
    monkeypatch.setattr(sinks.F, "current_timestamp", lambda: F.lit("2030-01-01 00:00:01").cast("timestamp"))
    pipeline.process_batch(m, root)
    for layer in ("manifests", "bronze/invalid", "bronze/malformed", "bronze/events", "signals/gold_ready"):
        days = {str(p.parent.relative_to(tmp_path / "lake" / layer)) for p in (tmp_path / "lake" / layer).rglob("part-*")}
        assert days and all("2026" in d or layer.startswith("signals") for d in days)
    assert readers.read_manifests(spark, f"{root}/manifests").count() == 1
    assert readers.read_invalid(spark, f"{root}/bronze/invalid").count() == 1 and readers.read_invalid(spark, f"{root}/bronze/malformed").count() == 1
    signal = spark.read.parquet(f"{root}/signals/gold_ready")
    held = readers.read_gold(spark, f"{root}/gold", signal.head()["object_uri"], "one")
    assert held.count() > 0 and validate.validate_gold_signal(signal, "file://").where(F.size("reasons") > 0).count() == 0


def kill(n, match, **more):
    from test_normalize_validate import KILL

    return KILL | {"event_id": f"{n:064x}", "match_id": match * 64, "payload": KILL["payload"] | {"match_id": match * 64, "event_time_seconds": float(n)}} | more


def batch(spark, events, offset, at="2026-07-28 10:00:00"):
    from test_normalize_validate import messages

    return messages(spark, events).withColumn("offset", F.col("offset") + offset).withColumn("timestamp", F.lit(at).cast("timestamp"))


def kills_by_match(spark, root):
    rows = lake.current(spark, root, "gold").groupBy("match_id").agg(F.max("kills").alias("k"), F.count("*").alias("n")).collect()
    return {r["match_id"][0]: (r["k"], r["n"]) for r in rows}


def test_only_touched_matches_are_recomputed(spark, tmp_path):
    root = f"file://{tmp_path}/lake"
    for n, events in enumerate(([kill(1, "a"), kill(2, "b")], [kill(3, "c")], [kill(4, "d"), kill(5, "b")], [kill(9, "a")])):
        done = pipeline.process_batch(batch(spark, events, 100 * n), root)
    assert kills_by_match(spark, root) == {"a": (2, 3), "b": (2, 3), "c": (1, 3), "d": (1, 3)}
    assert lake.current(spark, root, "silver/kill_events").count() == 6 and lake.bronze(spark, root).count() == 6
    # a batch of match a reads the bronze of the two batches that hold it, and its gold has no other match
    one = spark.createDataFrame([("a" * 64,)], "match_id string")
    assert len(lake.bronze_folders(spark, root, one, done["batch_id"])) == 2
    fresh = spark.read.parquet(f"{root}/gold/batch={done['batch_id']}")
    assert {r[0][0] for r in fresh.select("match_id").distinct().collect()} == {"a"}


def test_compaction_keeps_the_newest_rows(spark, tmp_path):
    root = f"file://{tmp_path}/lake"
    for n, events in enumerate(([kill(1, "a"), kill(2, "b")], [kill(3, "a")], [kill(4, "c")])):
        pipeline.process_batch(batch(spark, events, 100 * n), root)
    want = kills_by_match(spark, root)
    assert lake.compact(spark, root).startswith("base-3-") and lake.compact(spark, root) is None
    assert kills_by_match(spark, root) == want and len(lake.live_batches(spark, root)) == 1
    assert lake.vacuum(spark, root) == 12 and kills_by_match(spark, root) == want
    pipeline.process_batch(batch(spark, [kill(8, "a")], 900), root)
    assert kills_by_match(spark, root) == want | {"a": (3, 3)} and lake.bronze(spark, root).count() == 5


def test_a_batch_that_stops_half_way_is_not_seen(spark, tmp_path, monkeypatch):
    root = f"file://{tmp_path}/lake"
    pipeline.process_batch(batch(spark, [kill(1, "a")], 0), root)
    whole = lake.write_part

    def stops(df, root, layer, name):
        if layer == "gold":
            raise RuntimeError("lost")
        whole(df, root, layer, name)

    second = batch(spark, [kill(2, "a"), kill(3, "b")], 50)
    monkeypatch.setattr(lake, "write_part", stops)
    with pytest.raises(RuntimeError):
        pipeline.process_batch(second, root)
    monkeypatch.undo()
    assert kills_by_match(spark, root) == {"a": (1, 3)}
    assert lake.bronze(spark, root).count() == 1 and lake.current(spark, root, "silver/kill_events").count() == 1
    third = batch(spark, [kill(5, "a")], 90)
    pipeline.process_batch(third, root)  # does not take what was never committed
    assert kills_by_match(spark, root) == {"a": (2, 3)}
    pipeline.process_batch(second, root)
    assert kills_by_match(spark, root) == {"a": (3, 3), "b": (1, 3)}


def test_writers_of_a_log_lose_nothing(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    log = f"file://{tmp_path}/log"
    with ThreadPoolExecutor(8) as pool:
        numbers = list(pool.map(lambda n: lake.append(spark, log, {"version": f"v{n}"}), range(24)))
    held = {r["number"]: r["version"] for r in lake.entries(spark, log, "version string").collect()}
    assert sorted(numbers) == sorted(held) == list(range(1, 25)) and sorted(held.values()) == sorted(f"v{n}" for n in range(24))
    assert not lake.put_new(spark, f"{log}/{1:020d}.json", "{}") and held[numbers[3]] == "v3"


@pytest.mark.parametrize("names", [("v-3bbb", "v-9aaa"), ("v-9aaa", "v-3bbb")])
def test_the_later_version_is_served_whatever_its_name(spark, tmp_path, names):
    root = f"file://{tmp_path}/models"
    model, metrics = ml.train(gold(spark, label=lambda i: i % 3 == 0), rounds=1, depth=2)
    holder = pipeline.ModelHolder(spark, root)
    holder.refresh()
    assert holder.version is None
    for name in names:
        ml.save_bundle(model, metrics, root, name)
        holder.refresh()
        assert holder.version == name
    ml.save_bundle(model, metrics, root, "v-5")
    (tmp_path / "models/versions/v-5/.metrics.json.crc").unlink(missing_ok=True)
    (tmp_path / "models/versions/v-5/metrics.json").write_text("{}")  # broken: passed over
    holder.refresh()
    again = pipeline.ModelHolder(spark, root)
    again.refresh()
    assert holder.version == again.version == names[1]
    assert [r["version"] for r in ml.read_versions(spark, root).orderBy("number").collect()] == [*names, "v-5"]


def test_an_event_sent_again_is_dropped_in_later_batches(spark, tmp_path):
    cols = [f.name for f in readers.MESSAGE.fields]
    folder, root = str(tmp_path / "in"), f"file://{tmp_path}/lake"

    def send(events, offset):
        sent = batch(spark, events, offset).withColumn("topic", F.lit("raw")).withColumn("key", F.lit(b"k"))
        sent.select(cols).coalesce(1).write.mode("append").parquet(folder)

    def run():
        q = pipeline.start_pipeline(readers.read_message_files(spark, folder, 1), root, str(tmp_path / "cp"), across_batches=True)
        q.awaitTermination()
        return pipeline.dropped(q)

    send([kill(1, "a"), kill(2, "a")], 0)
    assert run() == 0
    send([kill(1, "a", ingest_time="2026-07-28T10:30:00Z"), kill(3, "a")], 100)  # another payload, the same event
    assert run() == 1  # a new query from the checkpoint remembers
    assert kills_by_match(spark, root) == {"a": (3, 3)} and lake.bronze(spark, root).count() == 3


def test_scoring_names_the_evidence_that_is_there(spark, tmp_path):
    root, lake_dir = f"file://{tmp_path}/models", str(tmp_path / "gold")
    gold(spark, label=lambda i: i % 3 == 0).write.parquet(lake_dir)
    ml.train_incremental(spark, lake_dir, root, rounds=1, depth=2)
    for name, extra in (("plain", {}), ("named", {"kills_per_minute": F.lit(9.0)})):
        rows = spark.read.parquet(lake_dir).withColumns(extra) if extra else spark.read.parquet(lake_dir)
        rows.write.parquet(str(tmp_path / name))
        stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / name))
        pipeline.start_scoring(stream, root, decision.FIVE_RULES, str(tmp_path / f"p-{name}"), str(tmp_path / f"cp-{name}")).awaitTermination()
        found = spark.read.parquet(str(tmp_path / f"p-{name}")).select(F.explode_outer("evidence.feature")).distinct().collect()
        assert [r[0] for r in found] == (["kills_per_minute"] if extra else [None])


def test_across_batches_drops_repeated_messages(spark, tmp_path):
    from test_normalize_validate import BASE, KILL, messages

    one = messages(spark, [BASE, KILL]).withColumn("topic", F.lit("raw")).withColumn("key", F.lit(b"k")).withColumn("timestamp", F.lit("2026-07-28 10:00:00").cast("timestamp"))
    cols = [f.name for f in readers.MESSAGE.fields]
    folder = str(tmp_path / "in")
    one.select(cols).coalesce(1).write.parquet(folder)
    one.withColumn("offset", F.col("offset") + 100).select(cols).coalesce(1).write.mode("append").parquet(folder)
    stream = readers.read_message_files(spark, folder, 1)
    pipeline.start_pipeline(stream, f"file://{tmp_path}/lake", str(tmp_path / "cp"), across_batches=True).awaitTermination()
    assert readers.read_manifests(spark, f"file://{tmp_path}/lake/manifests").agg(F.sum("total_records_read")).head()[0] == 2
    # both messages of the first batch have one event id: the batch counts that itself
    assert readers.read_manifests(spark, f"file://{tmp_path}/lake/manifests").agg(F.sum("duplicate_records_count")).head()[0] == 1


def test_training_stream_serves_valid_signals_once_and_keeps_the_rest(spark, tmp_path):
    root, lake = f"file://{tmp_path}/models", f"file://{tmp_path}/lake/gold"
    gold(spark, label=lambda i: i % 3 == 0).write.parquet(f"{lake}/one")
    good = ("b", "gold/one", "a" * 64, f"{lake}/one", "manifests/b")
    gone = ("b", "gold/two", "b" * 64, f"{lake}/two", "manifests/b")
    art = spark.createDataFrame([good, gone], "batch_id string, object_key string, checksum_sha256 string, object_uri string, source_manifest string")
    signals = sinks.gold_ready_signals(art)
    wrong = signals.limit(1).withColumn("op", F.lit("other"))
    sent = signals.unionByName(wrong).select(F.lit(b"k").alias("key"), F.to_json(F.struct("*")).cast("binary").alias("value"), F.lit("gold").alias("topic"), F.lit(0).alias("partition"), F.monotonically_increasing_id().alias("offset"), F.current_timestamp().alias("timestamp"))
    sent.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = readers.read_message_files(spark, str(tmp_path / "in"))
    for k in range(2):  # the second run, from a new checkpoint, trains nothing anew
        pipeline.start_training(stream, lake, root, str(tmp_path / f"cp{k}"), retries=2, wait=lambda s: None, scheme="file://", rounds=1, depth=2).awaitTermination()
        ready = spark.read.parquet(f"{root}/signals/model_ready").collect()
        version = ml.model_version(ready[0]["operation_id"], "a" * 64)
        assert len(ready) == 1 and ready[0]["model_version"] == version and ready[0]["op"] == "ml.model.ready" and ready[0]["model_name"] == "pubg-risk"
        made = (tmp_path / f"models/versions/{version}/checksums.json").stat().st_mtime
        if k:
            assert made == first
        first = made
    letters = spark.read.parquet(f"{root}/dead_letters")
    assert letters.where("error = 'op_not_gold_ready'").count() == 1 and letters.count() == 2 and letters.select("source_topic").distinct().head()[0] == "gold"
    assert ml.load_bundle(spark, f"{root}/versions/{version}")[1]["features"] == S.FEATURES


def test_manifests_and_rejects_in_any_json_form(spark, tmp_path):
    import json

    day = tmp_path / "manifests/year=2026/month=07/day=28"
    day.mkdir(parents=True)
    one = {"batch_id": "b1", "source_topic": "t", "partition_offsets": {"0": {"min_offset": 100, "max_offset": 250}}, "total_records_read": 151, "valid_records_count": 150, "invalid_records_count": 1, "duplicate_records_count": 0, "data_object_path": "bronze/x.parquet", "checksum_sha256": "c", "processing_timestamp": "2026-07-28T02:30:00Z"}
    (day / "b1.json").write_text(json.dumps(one, indent=2))
    (day / "b2.json").write_text(json.dumps(one | {"batch_id": "b2"}) + "\n" + json.dumps(one | {"batch_id": "b3"}))
    (tmp_path / "manifests/dataset-manifest.json").write_text(json.dumps({"total_records_read": 9}))
    m = readers.read_manifests(spark, str(tmp_path / "manifests"))
    rows = {r["batch_id"]: r for r in m.collect()}
    assert set(rows) == {"b1", "b2", "b3"} and rows["b1"]["partition_offsets"][0]["max_offset"] == 250
    total = reports.pipeline_summary(m).head()
    assert (total["total_raw"], total["total_valid"], total["total_batches"]) == (453, 450, 3)
    assert bronze.contract_manifest(m).where("kafka_partition = 0 and first_offset = 100 and status = 'completed'").count() == 3
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad/list.json").write_text(json.dumps([{"event_id": "e", "reasons": ["a", "b"]}, {"event_id": "f", "reasons": []}], indent=1))
    (tmp_path / "bad/object.json").write_text(json.dumps({"event_id": "g", "reasons": ["a"]}, indent=1))
    (tmp_path / "bad/lines.json").write_text('{"event_id": "h", "reasons": ["b"]}\n\n{"event_id": "i", "reasons": ["b"]}\n')
    assert {r["event_id"]: len(r["reasons"]) for r in readers.read_invalid(spark, str(tmp_path / "bad")).collect()} == {"e": 2, "f": 0, "g": 1, "h": 1, "i": 1}


def test_registry_lists_versions_without_metrics(spark, tmp_path):
    for v, names in (("v1", ["metrics.json", "training_manifest.json"]), ("v2", ["training_manifest.json"]), ("v3", ["metrics.json"])):
        (tmp_path / "versions" / v).mkdir(parents=True)
        for n in names:
            (tmp_path / "versions" / v / n).write_text('{\n"a": 1\n}')
    out = reports.model_registry(*readers.read_model_registry(spark, str(tmp_path)), "v2").collect()
    assert [(r["version"], r["metrics"] is None, r["training_manifest"] is None, r["is_active"]) for r in out] == [("v3", False, True, False), ("v2", True, False, True), ("v1", False, False, False)]


def test_no_rank_or_percentile_gathers_a_column(spark):
    from matchguard.operators import ranks

    df = spark.range(0, 1000, 1, 7).select((F.col("id") % 97).cast("double").alias("v"), F.col("id").alias("i"))
    plans = [d._jdf.queryExecution().toString() for d in (reports.describe_features(df, ["v"]), ml.anomaly_score_summary(df, "v"), ml.pseudo_labels(df, ["i"], "v"), ml.classification_metrics(df.select((F.col("v") / 97).alias("score"), F.lit(1).alias("label"))))]
    for plan in plans:
        assert "percentile(" not in plan and "TakeOrdered" not in plan and "GlobalLimit" not in plan
    values = sorted(i % 97 for i in range(1000))
    got = ranks.percentiles(df, "v", {"a": 0.0, "b": 0.123, "c": 0.5, "d": 1.0}).head()
    for name, p in (("a", 0.0), ("b", 0.123), ("c", 0.5), ("d", 1.0)):
        assert abs(got[name] - float(np.quantile(values, p))) < 1e-9
    assert [r["rank"] for r in ranks.ranked(df, ["v", "i"]).orderBy("v", "i").collect()] == list(range(1, 1001))
    assert ranks.percentiles(df.where("false"), "v", {"a": 0.5}).collect() == [] and ranks.ranked(df.where("false"), ["v"]).count() == 0
    empty = ml.anomaly_score_summary(df.where("false"), "v").head()
    assert empty["p05"] is None and empty["mean"] is None
