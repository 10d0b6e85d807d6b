"""Structured Streaming entries: pipeline, training trigger, scoring (ST1-ST10).

Offsets live in the query's checkpoint and commit last. Every sink of a batch is
named by the batch's offsets and replaces itself, so a batch that fails half-way
is done again without traces; until it is committed, no reader of the lake sees
any of it.
"""

from __future__ import annotations

import functools
import time
from collections.abc import Callable
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import schemas as S
from ..operators import bronze as B
from ..operators import dedup, envelope, gold, ml, silver, validate
from ..operators.decision import Policy
from ..operators.scoring import predict
from ..functions.expr import rfc3339
from ..sources import lake, readers, sinks
from ..sources.folders import checksums, exists, kept, shuffles_removed


_ENVELOPE = ("kind", "schema_version", "event_id", "op", "event_time", "ingest_time", "match_id", "player_id", "source", "kill", "stat", "reasons")


def _judged(messages: DataFrame, max_bytes: int) -> DataFrame:
    """Every message once, with its envelope, all failed rules, ``status`` and whether an earlier message of the batch has its event id.

    One shuffle by event id; messages without a valid one are dealt by their place.
    """
    parsed = envelope.parse_envelopes(messages, max_bytes)
    checked = validate.validate_events(envelope.opened(parsed))
    status = F.when(F.col("kind") == "malformed", "malformed").when(F.size("reasons") > 0, "invalid").otherwise("valid")
    place = [c for c in ("topic", "timestamp") if c in messages.columns]
    # only malformed messages are needed as bytes from here on
    rows = checked.select(*place, "partition", "offset", status.alias("status"), "reject_reason", F.when(status == "malformed", F.col("value")).alias("value"), *_ENVELOPE)
    own = F.when(F.col("status") == "valid", F.col("event_id")).otherwise(F.concat_ws(":", F.lit("at"), "partition", "offset"))
    first = Window.partitionBy(own).orderBy("partition", "offset")
    return rows.withColumn("duplicate", (F.col("status") == "valid") & (F.row_number().over(first) > 1))


def _envelopes(judged: DataFrame) -> DataFrame:
    return judged.select(*(c for c in ("topic", "partition", "offset") if c in judged.columns), *(c for c in _ENVELOPE if c != "reasons"))


def process_batch(messages: DataFrame, root: str, identity: str = "canonical", max_bytes: int = 1_048_576, short_interval_threshold: float = 10.0) -> dict | None:
    """One micro-batch: rejects, bronze, manifest, then silver and gold of the matches it touched, the commit, and the signal.

    Touched matches are recomputed from the bronze of the batches that hold them
    (ST10), so one that spans batches is right. Folders are named by the day of the batch's newest message
    (``timestamp``; without one, 1970) and by its offsets.
    """
    spark = messages.sparkSession
    with shuffles_removed(spark), kept(_judged(messages, max_bytes), f"{root}/_work") as judged:
        newest = [F.max("timestamp").alias("at")] if "timestamp" in judged.columns else []
        topic = [F.min("topic").alias("topic")] if "topic" in judged.columns else []
        seen = judged.agg(F.count("*").alias("n"), *(F.count_if(F.col("status") == s).alias(s) for s in ("valid", "invalid", "malformed")), *newest, *topic).head()
        if not seen["n"]:
            return None
        key = B.batch_id(B.partition_offsets(judged)).head()["batch_id"]
        at = F.lit(seen["at"] if newest and seen["at"] is not None else datetime(1970, 1, 1)).cast("timestamp")
        if seen["malformed"]:
            sinks.write_malformed(envelope.malformed(judged), f"{root}/bronze/malformed", key, at)
        if seen["invalid"]:
            sinks.write_invalid_records(validate.invalid_envelopes(judged.where("status = 'invalid'")), f"{root}/bronze/invalid", key, at)
        fresh = B.to_bronze(_envelopes(judged.where("status = 'valid' AND NOT duplicate")))
        place, checksum = F.lit(None).cast("string"), F.lit(None).cast("string")
        some = bool(seen["valid"])
        if some:
            day = spark.range(1).select(F.date_format(at, "'year='yyyy'/month='MM'/day='dd").alias("d")).head()["d"]
            path = f"{root}/bronze/events/{day}/batch={key}"
            sinks.write_bronze(fresh.repartitionByRange("match_id").sortWithinPartitions("match_id"), f"{root}/bronze/events", key, at)
            sums = checksums(spark, [path]).agg(F.sha2(F.array_join(F.array_sort(F.collect_list("checksum_sha256")), "\n"), 256).alias("c"))
            place, checksum = F.lit(path), F.lit(sums.head()["c"])
        name = F.lit(seen["topic"]) if topic else "raw"
        sinks.write_manifest(B.batch_manifest(judged, path=place, checksum=checksum, now=rfc3339(at), topic=name), f"{root}/manifests", key, at)
        if some:
            refresh_matches(spark, root, fresh, key, day, identity, short_interval_threshold)
            lake.commit(spark, root, key)
            _signal(spark, root, key, at)
        return {"batch_id": key}


def _signal(spark: SparkSession, root: str, key: str, at: Column) -> None:
    """The signal for the batch's gold folder, with its checksum."""
    folder = f"{root}/gold/batch={key}"
    if not exists(spark, folder):
        return
    day = F.date_format(at, "yyyy/MM/dd").alias("day")
    artifacts = checksums(spark, [folder]).select(
        F.lit(key).alias("batch_id"), F.lit(f"gold/batch={key}").alias("object_key"), "checksum_sha256",
        F.lit(folder).alias("object_uri"), F.concat(F.lit("manifests/"), day, F.lit(f"/{key}")).alias("source_manifest"),
    )
    out = sinks.gold_ready_signals(artifacts, rfc3339(at)).withColumn("batch", F.lit(key))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{root}/signals/gold_ready")


def refresh_matches(spark: SparkSession, root: str, touched: DataFrame, key: str, day: str, identity: str = "canonical", short_interval_threshold: float = 10.0) -> None:
    """Write silver and gold of the touched matches as parts of batch ``key``; of bronze only the folders are read that hold them."""
    matches = touched.select("match_id").distinct()
    lake.write_part(matches.select("match_id", F.lit(day).alias("day"), F.lit(key).alias("source_batch")), root, "index", key)
    events = spark.read.schema(S.BRONZE).parquet(*lake.bronze_folders(spark, root, matches, key)).join(matches, "match_id", "left_semi")
    # names are hashed where silver is made: as text they are shorter
    needed = dict.fromkeys([*(f.name for f in S.SILVER_KILL_EVENTS.fields), *S.METRICS, "op", "match_id", "player_id", "killer_name", "victim_name", "event_id", "source_file", "source_record_index"])
    with kept(dedup.dedup_bronze(events.select(*needed)).drop("source_file", "source_record_index"), f"{root}/_work") as events:
        if identity == "canonical":
            events = silver.canonical_identity(events)
        for name, fresh in zip(lake.LAYERS[:2], (silver.to_silver_kill_events(events, identity), silver.player_match(events, identity)), strict=True):
            lake.write_part(fresh, root, name, key)
    # gold is made of the silver just written
    kills, pm = (lake.part(spark, root, name, key, schema) for name, schema in zip(lake.LAYERS[:2], (S.SILVER_KILL_EVENTS, None), strict=True))
    lake.write_part(gold.gold_features(pm, kills, short_interval_threshold), root, lake.LAYERS[2], key)


def mark_repeats(stream: DataFrame, memory: str = "1 hour") -> DataFrame:
    """ST4: the messages with ``_repeat``, true if an earlier batch had the same event id less than ``memory`` ago.

    Repeats within one batch are not marked: the batch itself counts them. A message without an id that
    reads as one is known by its bytes. An id's state is two numbers and ends with a timer; its rows come
    in Arrow batches and are never held together. Messages older than the watermark are left out.
    """
    text = F.try_validate_utf8(F.col("value").cast("string"))
    named = F.get_json_object(text, "$.event_id")
    known = F.when(named.rlike(r"\A[0-9a-f]{64}\z"), named).otherwise(F.concat(F.lit("bytes:"), F.sha2("value", 256)))
    keep_ms, cols = int(pd.Timedelta(memory).total_seconds() * 1000), stream.columns

    def mark(key, parts, state):
        if state.hasTimedOut:
            state.remove()
            return
        before, newest = state.exists, state.get[0] if state.exists else 0
        for rows in parts:
            at = rows["timestamp"].max()
            newest = newest if pd.isna(at) else max(newest, int(at.value // 1_000_000))
            yield rows[cols].assign(_repeat=before)
        state.update((newest,))
        state.setTimeoutTimestamp(max(newest, state.getCurrentWatermarkMs()) + keep_ms)

    fields = T.StructType([*stream.schema.fields, T.StructField("_repeat", T.BooleanType())])
    keyed = stream.withColumn("_e", known).withWatermark("timestamp", memory).groupBy("_e")
    return keyed.applyInPandasWithState(mark, fields, "newest long", "append", "EventTimeTimeout")


def start_pipeline(stream: DataFrame, root: str, checkpoint: str, trigger: dict | None = None, identity: str = "canonical", across_batches: bool = False, short_interval_threshold: float = 10.0, memory: str = "1 hour") -> StreamingQuery:
    """ST1-ST7, ST10. ``across_batches`` also drops events whose id came in an earlier batch (within ``memory``).

    The ids are kept in the query's state, so a restart knows them. :func:`dropped` tells how many were dropped.
    """
    if across_batches:
        stream = mark_repeats(stream, memory).observe("across_batches", F.count_if("_repeat").alias("repeats"))

    def run(df: DataFrame, _: int) -> None:
        process_batch(df.where(~F.col("_repeat")).drop("_repeat") if across_batches else df, root, identity, short_interval_threshold=short_interval_threshold)

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def dropped(query: StreamingQuery) -> int:
    """ST4: rows that the query's progress reports as repeats of earlier batches' events."""
    seen = (p["observedMetrics"].get("across_batches") for p in query.recentProgress if "observedMetrics" in p)
    return sum(int(m["repeats"]) for m in seen if m is not None)


def with_retries(work: Callable[[], None], retries: int = 3, wait: Callable[[float], None] = time.sleep) -> Exception | None:
    """ST8: tries with back-off min(60, 2**n) seconds; the last error, or None."""
    if not 1 <= retries <= 20:
        raise ValueError("1 to 20 tries")
    error: Exception | None = None
    for n in range(retries):
        try:
            work()
            return None
        except Exception as e:  # noqa: BLE001  any failure of a try is retried, then reported
            error = e
            if n + 1 < retries:
                wait(min(60.0, 2.0**n))
    return error


def start_training(signals: DataFrame, gold_root: str, model_root: str, checkpoint: str, retries: int = 3, trigger: dict | None = None, wait: Callable[[float], None] = time.sleep, scheme: str = "s3://", **params) -> StreamingQuery:
    """ST8: each valid signal trains the version that its id and checksum name, so a repeated signal trains nothing anew.

    Signals that do not validate, and those whose training keeps failing, go to
    the dead letters; then the batch is committed. ``signals`` are messages whose
    value is the signal as JSON; a micro-batch of them is what the trigger lets in.
    """

    def serve(spark: SparkSession, signal: Row) -> None:
        version = ml.model_version(signal["event_id"], signal["checksum_sha256"])
        if not exists(spark, f"{model_root}/versions/{version}/checksums.json"):
            rows = readers.read_gold(spark, gold_root, signal["object_uri"], "one")
            model, metrics = ml.train(rows, **params)
            ml.save_bundle(model, metrics, model_root, version, source={"object_uri": signal["object_uri"], "checksum_sha256": signal["checksum_sha256"]})
        texts = spark.read.text(f"{model_root}/versions/{version}/metrics.json", wholetext=True)
        made = texts.select(F.lit(signal["event_id"]).alias("operation_id"), F.lit(version).alias("model_version"), F.lit(f"{model_root}/versions/{version}").alias("bundle_uri"), F.from_json("value", "map<string,string>").alias("metrics"))
        ready = sinks.model_ready_signals(made).withColumn("version", F.lit(version))
        ready.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(f"{model_root}/signals/model_ready")

    def run(batch: DataFrame, number: int) -> None:
        if not batch.head(1):
            return
        spark = batch.sparkSession
        parsed = batch.withColumn("s", F.from_json(F.col("value").cast("string"), S.GOLD_SIGNAL))
        checked = validate.validate_gold_signal(parsed.select("topic", "partition", "offset", "value", *(F.col(f"s.{f.name}").alias(f.name) for f in S.GOLD_SIGNAL.fields)), scheme)
        failed = [checked.where(F.size("reasons") > 0).withColumn("error", F.array_join("reasons", ","))]
        good = checked.where(F.size("reasons") == 0)
        for signal in good.select("event_id", "checksum_sha256", "object_uri").distinct().orderBy("event_id").toLocalIterator():
            error = with_retries(functools.partial(serve, spark, signal), retries, wait)
            if error is not None:
                failed.append(good.where((F.col("event_id") == signal["event_id"]) & (F.col("checksum_sha256") == signal["checksum_sha256"])).withColumn("error", F.lit(str(error))))
        letters = functools.reduce(DataFrame.unionByName, (f.select("topic", "partition", "offset", "value", "error") for f in failed))
        out = sinks.training_dead_letters(letters).withColumn("batch", F.lit(number))
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{model_root}/dead_letters")

    return signals.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


class ModelHolder:
    """ST9: of the versions in order of their making the newest that verifies; a bad candidate never replaces a good model."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.version, self.model, self.schema = spark, root, None, None, None

    def refresh(self) -> None:
        made = ml.read_versions(self.spark, self.root).orderBy(F.desc("number")).toLocalIterator()  # the newest come first; usually one is read
        for name in (r["version"] for r in made):
            if name == self.version:
                return
            try:
                self.model, self.schema = ml.load_bundle(self.spark, f"{self.root}/versions/{name}")
            except Exception:  # noqa: BLE001  a broken bundle is passed over
                continue
            self.version = name
            return


def start_scoring(gold_stream: DataFrame, model_root: str, policy: Policy, out: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """ST9: predictions for every gold row, with the model reloaded between batches.

    Evidence names only the evidence features that the rows have as columns.
    """
    holder = ModelHolder(gold_stream.sparkSession, model_root)

    def run(batch: DataFrame, number: int) -> None:
        holder.refresh()
        if holder.model is None:
            raise RuntimeError("no verified model")
        cols = holder.schema["features"]
        feats = F.array(*(F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols))
        named = {n: S.EVIDENCE_COLUMNS.get(n, n) for n in S.EVIDENCE_FEATURES if S.EVIDENCE_COLUMNS.get(n, n) in batch.columns}
        requests = batch.select(F.lit("predict").alias("op"), "match_id", "player_id", feats.alias("features"), *(F.col(c).alias(f"_named_{n}") for n, c in named.items()))
        scored = requests.withColumn("risk_score", holder.model.score("features").cast("float"))
        done = predict(scored, F.col("risk_score"), policy, holder.version, len(cols), named={n: F.col(f"_named_{n}") for n in named})
        if done.head(1):
            sinks.write_predictions(done.withColumn("batch", F.lit(number)), out, by=["model_version", "batch"])

    return gold_stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
