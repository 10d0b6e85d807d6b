"""Queries of sources, sinks, signals, checks and scalar functions: given tables written, read back and compared.

Each has its SQL beside it, written from the rules and not from the code.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import expr as E
from ..operators import bronze as B
from ..operators import decision, envelope, evidence, features, gold, ml, normalize, quality, reports, scoring, silver, validate
from ..sources import readers, sinks
from ..sources.folders import scratch
from . import adapters as A
from .queries import _GOLD, _MAN, _PREDS, _RAW_STATS, _RATES, _SERVED, EVIDENCE_ITEMS, SHORT, WITH_KILLS, WITH_STATS, _gold, _manifests, _named, _preds, _raw_stats, _shown, query, served



def at() -> Column:
    return F.lit("2026-07-28 02:30:00").cast("timestamp")


def now() -> Column:
    return F.lit("2026-07-28T02:30:00Z")


def _text(c: str) -> Column:
    return F.col(c).cast("string")


# -- files and lake layers ----------------------------------------------------

_ROW = ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_suppkey"]


def _csv_files(spark: SparkSession, sf_dir: str) -> str:
    """lineitem as seven CSV files, one a line number, cells padded with blanks; a file lies in parts that follow each other, so that no task writes the whole of it."""
    path = scratch(spark, "csv")
    li = A.table(spark, sf_dir, "lineitem")
    cells = li.select("*", F.col("l_linenumber").alias("file")).repartitionByRange("file", *_ROW).sortWithinPartitions("file", *_ROW)
    padded = cells.select("file", F.concat(F.lit("  s"), _text("l_suppkey"), F.lit("\t")).alias(" Id "), F.concat(F.lit("m"), _text("l_orderkey")).alias("matchId"), F.concat(F.lit(" "), _text("l_partkey")).alias("kills"), F.when(F.col("l_partkey") % 3 == 0, F.lit("")).otherwise('a "b", c').alias("note"), _text("l_linenumber").alias("line"))
    padded.write.partitionBy("file").option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


@query("SELECT 's' || l_suppkey AS player, CASE WHEN l_partkey % 3 = 0 THEN '' ELSE 'a \"b\", c' END AS note, 'finish_placement' AS layout, count(*) AS n, CAST(sum(l_partkey) AS BIGINT) AS kills FROM lineitem GROUP BY 1, 2, 3")
def csv_round_trip(spark, sf_dir):
    """Cells and header names come back trimmed, quotes and blanks whole."""
    df = readers.read_raw_csv(spark, _csv_files(spark, sf_dir))
    return df.groupBy(F.col("Id").alias("player"), "note", F.lit(normalize.detect_schema(df)).alias("layout")).agg(F.count("*").alias("n"), F.sum(E.parse_long("kills")).alias("kills"))


_DOC_TEXT = r"trim(replace(text, chr(13) || chr(10), chr(10)), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(133) || chr(160) || chr(8232) || chr(8233))"


@query(f"""SELECT CAST(doc_id AS VARCHAR) AS doc, sha256({_DOC_TEXT}) AS text_sha, CASE WHEN doc_id % 3 = 0 THEN '' ELSE lang END AS lang, length({_DOC_TEXT}) AS chars FROM documents WHERE text IS NOT NULL""")
def csv_quoted_records(spark, sf_dir):
    """Texts with line ends, quotes and commas in files of three unlike headers, read in one call."""
    path = scratch(spark, "csv-texts")
    docs = A.table(spark, sf_dir, "documents").where("text is not null").withColumn("file", F.col("doc_id") % 3)
    for n, order in enumerate((["text", "doc_id"], ["doc_id", "lang", "text"], ["lang", "text", "doc_id"])):
        docs.where(F.col("file") == n).select(*order).write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{path}/part={n}")
    df = readers.read_raw_csv(spark, path)
    return df.select(F.col("doc_id").alias("doc"), E.sha256("text").alias("text_sha"), "lang", F.length("text").cast("bigint").alias("chars"))


@query(f"SELECT CAST(l_linenumber AS VARCHAR) AS line, 'm' || l_orderkey AS match, row_number() OVER (PARTITION BY l_linenumber ORDER BY {', '.join(_ROW)}) AS record_index FROM lineitem")
def record_index(spark, sf_dir):
    """The number of each row in its file."""
    return normalize.with_record_index(readers.read_raw_csv(spark, _csv_files(spark, sf_dir)), "file").select("line", F.col("matchId").alias("match"), "record_index")


@query("SELECT event_id AS record_index, user_id FROM events WHERE event_id >= 100 ORDER BY event_id LIMIT 2500")
def replay_slice(spark, sf_dir):
    """S3: the replay's own limit."""
    e = A.table(spark, sf_dir, "events").select(F.col("event_id").alias("record_index"), "user_id")
    return normalize.replay_slice(e, 100, 2500)


def _sent(messages: DataFrame, name: str) -> DataFrame:
    path = scratch(messages.sparkSession, name)
    sinks.write_topic(messages, name, {}, "parquet", path)
    return messages.sparkSession.read.parquet(path)


@query(f"{WITH_KILLS} SELECT match_id AS key, count(*) AS n, CAST(sum(killer_placement) AS BIGINT) AS placements, min(sha256('kill:' || row_id)) AS first_id FROM k GROUP BY 1")
def event_topic(spark, sf_dir):
    """Envelopes as messages keyed by match."""
    m = _sent(sinks.event_messages(A.kill_envelopes(spark, sf_dir)), "topic").select(_text("key").alias("key"), F.from_json(_text("value"), S.KILL_EVENT_ENVELOPE).alias("v"))
    return m.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.col("v.payload.killer_placement").cast("bigint")).alias("placements"), F.min("v.event_id").alias("first_id"))


@query(f"""WITH {_RAW_STATS}, bad AS (SELECT list_filter([CASE WHEN player = '' THEN 'player_id_blank' END, CASE WHEN bad_kills THEN 'kills_invalid' END, CASE WHEN heads > kills THEN 'headshot_kills_over_kills' END, CASE WHEN walk < 0 THEN 'walk_distance_negative' END], lambda e : e IS NOT NULL) AS errors, player FROM r)
SELECT 'lineitem.csv' AS key, array_to_string(errors, ',') AS errors, player, count(*) AS n FROM bad WHERE len(errors) > 0 GROUP BY 1, 2, 3""")
def invalid_topic(spark, sf_dir):
    """Rejects with their raw cells, keyed by file."""
    bad = normalize.split_valid_invalid(normalize.normalize(_raw_stats(spark, sf_dir), "lineitem"), now())[1]
    m = _sent(sinks.invalid_messages(bad), "rejects").select(_text("key").alias("key"), F.from_json(_text("value"), "validation_errors array<string>, raw_fields map<string,string>").alias("v"))
    return m.groupBy("key", F.array_join("v.validation_errors", ",").alias("errors"), F.col("v.raw_fields")["Id"].alias("player")).agg(F.count("*").alias("n"))


@query("SELECT '2026' AS year, '07' AS month, '28' AS day, 'b1' AS batch, 'data.kill_event.raw' AS op, count(*) AS n FROM events UNION ALL SELECT '2026', '07', '28', 'b1', 'data.player_stat.match_summary', count(*) FROM lineitem")
def bronze_lake(spark, sf_dir):
    """A batch written twice is there once, below its day."""
    path, b = scratch(spark, "bronze"), A.bronze(spark, sf_dir)
    for _ in range(2):
        sinks.write_bronze(b, path, "b1", at())
    day = F.regexp_extract_all(F.col("_metadata.file_path"), F.lit("(?:year|month|day|batch)=([^/]+)"), 1)
    rows = readers.read_bronze(spark, path).select("op", day.alias("d"))
    return rows.groupBy(*(F.col("d")[i].alias(n) for i, n in enumerate(("year", "month", "day", "batch"))), "op").agg(F.count("*").alias("n"))


_BAD_BOTH = """SELECT 'headshot_kills_over_kills' AS reason FROM s WHERE headshot_kills > kills UNION ALL SELECT 'win_place_perc_out_of_range' FROM s WHERE win_place_perc > 1 OR win_place_perc < 0
UNION ALL SELECT 'killer_placement_not_positive' FROM k WHERE killer_placement <= 0 UNION ALL SELECT 'victim_placement_not_positive' FROM k WHERE victim_placement <= 0 UNION ALL SELECT 'match_id_mismatch' FROM k WHERE row_id % 19 = 0"""


def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes of both kinds, every nineteenth kill with another match in its payload."""
    e = A.envelopes(spark, sf_dir)
    wrong = (F.col("kind") == "kill") & (F.col("source.record_index") % 19 == 0)
    return validate.validate_events(e.withColumn("kill", F.when(wrong, F.col("kill").withField("match_id", F.lit("other"))).otherwise(F.col("kill"))))


@query(f"{WITH_KILLS}, s AS ({A.STATS}) SELECT reason, count(*) AS records FROM ({_BAD_BOTH}) GROUP BY 1")
def validate_events(spark, sf_dir):
    """P14."""
    return _validated(spark, sf_dir).select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("records"))


@query(f"{WITH_KILLS}, s AS ({A.STATS}) SELECT reason, count(*) AS records FROM ({_BAD_BOTH}) GROUP BY 1")
def rejects_lake(spark, sf_dir):
    """Rejects as JSON and back."""
    path = scratch(spark, "invalid")
    sinks.write_invalid_records(validate.invalid_envelopes(_validated(spark, sf_dir)), path, "b1", at())
    return readers.read_invalid(spark, path).select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("records"))


@query("SELECT doc_id AS \"offset\", CASE WHEN coalesce(text, '') = '' THEN 'empty_payload' WHEN strlen(text) > 1048576 THEN 'payload_too_large' ELSE 'unparseable_payload' END AS reason, base64(array_slice(encode(text), 1, 1048576)) AS payload_base64, sha256(array_slice(encode(coalesce(text, '')), 1, 1048576)) AS payload_sha256 FROM documents")
def malformed_lake(spark, sf_dir):
    """Texts are no envelopes; their bytes are kept, of over-long ones the limit's; empty ones are named so."""
    docs = A.table(spark, sf_dir, "documents")
    sent = docs.select(F.col("text").cast("binary").alias("value"), F.lit("raw").alias("topic"), F.lit(0).alias("partition"), F.col("doc_id").alias("offset"))
    path = scratch(spark, "malformed")
    sinks.write_malformed(envelope.malformed(envelope.parse_envelopes(sent)), path, "b1", at())
    return readers.read_invalid(spark, path).select("offset", "reason", "payload_base64", "payload_sha256")


@query("SELECT CASE WHEN text IS NULL OR text = '' THEN 'empty_payload' WHEN strlen(text) > 2000 THEN 'payload_too_large' ELSE 'taken' END AS reason, count(*) AS n, CAST(coalesce(sum(least(strlen(text), 2000)), 0) AS BIGINT) AS bytes FROM documents GROUP BY 1")
def classify_payload(spark, sf_dir):
    """P10: over-long payloads keep a prefix of the limit's bytes."""
    d = envelope.classify_payload(A.table(spark, sf_dir, "documents").select(F.col("text").cast("binary").alias("value")), 2000)
    return d.groupBy(F.coalesce("reject_reason", F.lit("taken")).alias("reason")).agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("value")), F.lit(0)).cast("bigint").alias("bytes"))


@query(f"{_GOLD} SELECT * FROM gold")
def gold_lake(spark, sf_dir):
    """Gold written by bucket and all files read as one."""
    path = scratch(spark, "gold")
    k = A.kills(spark, sf_dir)
    sinks.write_gold(gold.gold_features(silver.participants(k).withColumn("kills", F.lit(0).cast("bigint")), k, SHORT), path, 16)
    return readers.read_gold(spark, path).drop("feature_version", "created_at", "match_bucket")


@query(f"{WITH_KILLS}, s AS ({A.STATS}) SELECT match_id, killer_name, count(*) AS kills, count(weapon) AS armed, round(sum(event_time_seconds), 3) AS seconds FROM k GROUP BY 1, 2")
def silver_lake(spark, sf_dir):
    """S11, S16."""
    path = scratch(spark, "silver")
    b = A.bronze(spark, sf_dir).where(F.col("op") == S.OP_KILL_RAW)
    sinks.write_silver(silver.to_silver_kill_events(b), silver.player_match(b), path, 16)
    ke = readers.read_kill_events(spark, f"{path}/kill_events")
    return ke.groupBy("match_id", "killer_name").agg(F.count("*").alias("kills"), F.count("weapon").alias("armed"), F.round(F.sum("event_time_seconds"), 3).alias("seconds"))


def _manifest_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "manifests")
    m = B.batch_manifest(A.messages(spark, sf_dir), path=F.concat(F.lit("bronze/batch="), _text("batch")), now=now(), by=["batch"])
    for _ in range(2):
        sinks.write_manifest(m.drop("batch"), path, "all", at())
    return readers.read_manifests(spark, path)


@query(f"""{_MAN}, off AS (SELECT batch, string_agg(part || ':' || lo || '-' || hi, ',' ORDER BY part) AS offsets FROM o GROUP BY 1)
SELECT batch_id, 'pubg.v1.player-stat.raw' AS source_topic, offsets, total_records_read, valid_records AS valid_records_count, invalid_records AS invalid_records_count, duplicate_records AS duplicate_records_count,
'bronze/batch=' || batch AS data_object_path, '2026-07-28T02:30:00Z' AS processing_timestamp FROM man JOIN off USING (batch)""")
def manifest_lake(spark, sf_dir):
    """Manifests as JSON and back, written twice."""
    pairs = F.transform(F.array_sort(F.map_entries("partition_offsets")), lambda e: F.concat(e["key"].cast("string"), F.lit(":"), e["value"]["min_offset"].cast("string"), F.lit("-"), e["value"]["max_offset"].cast("string")))
    return _manifest_lake(spark, sf_dir).select("batch_id", "source_topic", F.array_join(pairs, ",").alias("offsets"), "total_records_read", "valid_records_count", "invalid_records_count", "duplicate_records_count", "data_object_path", "processing_timestamp")


@query(f"{_MAN} SELECT batch_id, 'bronze/batch=' || batch AS path, total_records_read FROM man WHERE batch_id = (SELECT min(batch_id) FROM man)")
def manifest_bronze_lookup(spark, sf_dir):
    """A batch's manifest row and where its rows are."""
    m = _manifest_lake(spark, sf_dir)
    first = m.agg(F.min("batch_id")).head()[0]
    return reports.filter_batches(m, first).select("batch_id", F.lit(reports.manifest_bronze_path(m, first)).alias("path"), "total_records_read")


@query(f"{_PREDS} SELECT match_id, player_id, risk_level, 'v1' AS model_version, round(risk_score::DOUBLE, 5) AS risk_score FROM lv WHERE risk_level = 'LOW'")
def prediction_lake(spark, sf_dir):
    """Predictions by model version, filtered by level and model."""
    path = scratch(spark, "predictions")
    sinks.write_predictions(_preds(spark, sf_dir), path)
    found = reports.filter_predictions(spark.read.parquet(path), "LOW", "v1")
    return found.select("match_id", "player_id", "risk_level", "model_version", F.round(F.col("risk_score").cast("double"), 5).alias("risk_score"))


# -- signals and models --------------------------------------------------------


def _gold_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A signal for each batch; some are then spoilt."""
    m = _manifests(spark, sf_dir)
    art = m.select("batch_id", F.concat(F.lit("gold/"), _text("batch")).alias("object_key"), F.sha2("batch_id", 256).alias("checksum_sha256"), F.concat(F.when(F.col("batch") % 5 == 0, "http").otherwise("s3"), F.lit("://lake/gold/"), _text("batch")).alias("object_uri"), F.concat(F.lit("manifests/"), "batch_id").alias("source_manifest"))
    sig = sinks.gold_ready_signals(art, now())
    return sig.withColumn("checksum_sha256", F.when(F.col("object_uri").endswith("3"), F.upper("checksum_sha256")).otherwise(F.col("checksum_sha256")))


_SIGNALS = f"{_MAN}, sg AS (SELECT batch, batch_id, sha256(batch_id) AS c, sha256(batch_id || '|gold/' || batch || '|' || sha256(batch_id)) AS event_id FROM man)"


@query(f"""{_SIGNALS} SELECT '1.0' AS schema_version, event_id, 'data.dataset.gold.ready' AS op, batch_id, CASE WHEN batch % 5 = 0 THEN 'http' ELSE 's3' END || '://lake/gold/' || batch AS object_uri, 'manifests/' || batch_id AS source_manifest,
CASE WHEN batch % 10 = 3 THEN upper(c) ELSE c END AS checksum_sha256, '2026-07-28T02:30:00Z' AS created_at, array_to_string(list_filter([CASE WHEN batch % 10 = 3 THEN 'checksum_not_sha256' END, CASE WHEN batch % 5 = 0 THEN 'object_uri_not_s3' END], lambda e : e IS NOT NULL), ',') AS reasons FROM sg""")
def gold_signals(spark, sf_dir):
    """S18, P17."""
    return validate.validate_gold_signal(_gold_signals(spark, sf_dir)).withColumn("reasons", F.array_join("reasons", ","))


@query(f"""{_SIGNALS}, v AS (SELECT *, 'v-' || left(sha256(event_id || '|' || CASE WHEN batch % 10 = 3 THEN upper(c) ELSE c END), 16) AS model_version FROM sg)
SELECT sha256('model.ready|' || event_id || '|' || model_version) AS event_id, 'ml.model.ready' AS op, event_id AS operation_id, 'pubg-risk' AS model_name, model_version, 'kill-event-player-match-v1' AS feature_version, 'models/' || model_version AS bundle_uri FROM v""")
def model_signals(spark, sf_dir):
    """The version that each gold signal names, and its signal."""
    s = _gold_signals(spark, sf_dir)
    made = s.select(F.col("event_id").alias("operation_id"), ml.version_of("event_id", "checksum_sha256").alias("model_version")).withColumn("bundle_uri", F.concat(F.lit("models/"), "model_version")).withColumn("metrics", F.create_map(F.lit("f1"), F.lit(1.0)))
    return sinks.model_ready_signals(made, now()).select("event_id", "op", "operation_id", "model_name", "model_version", "feature_version", "bundle_uri")


@query("""SELECT sha256('gold|' || (event_id % 6) || '|' || event_id) AS event_id, 'ml.dataset.gold.ready.dlq' AS op, 'gold' AS source_topic, CAST(event_id % 6 AS INTEGER) AS "partition", event_id AS "offset", props AS payload, base64(encode(props)) AS payload_base64,
CAST(least(2000, 5 * (event_id % 1000)) AS INTEGER) AS error_length FROM events""")
def training_dead_letters(spark, sf_dir):
    """S20."""
    e = A.table(spark, sf_dir, "events")
    failed = e.select(F.lit("gold").alias("topic"), (F.col("event_id") % 6).cast("int").alias("partition"), F.col("event_id").alias("offset"), F.col("props").cast("binary").alias("value"), F.repeat(F.lit("error"), (F.col("event_id") % 1000).cast("int")).alias("error"))
    return sinks.training_dead_letters(failed, now()).select("event_id", "op", "source_topic", "partition", "offset", "payload", "payload_base64", F.length("error").alias("error_length"))


@query("""SELECT 'v' || n_nationkey AS version, CASE WHEN n_nationkey % 5 <> 0 THEN '{"name": "' || n_name || '"}' END AS metrics, CASE WHEN n_nationkey % 3 <> 0 OR n_nationkey % 5 = 0 THEN '{"region": ' || n_regionkey || '}' END AS training_manifest, n_nationkey = 7 AS is_active FROM nation""")
def model_registry(spark, sf_dir):
    """A version a nation, some without metrics or manifest."""
    root = scratch(spark, "registry")
    for r in A.table(spark, sf_dir, "nation").collect():  # a version is a folder: 25 of them
        n = r["n_nationkey"]
        if n % 5:
            ml._write_text(spark, f"{root}/versions/v{n}/metrics.json", f'{{"name": "{r["n_name"]}"}}')
        if n % 3 or not n % 5:
            ml._write_text(spark, f"{root}/versions/v{n}/training_manifest.json", f'{{"region": {r["n_regionkey"]}}}')
    return reports.model_registry(*readers.read_model_registry(spark, root), "v7")


@query(f"{_GOLD} SELECT match_id, player_id, kills FROM gold WHERE minimum_kill_interval_seconds IS NOT NULL AND median_kill_distance_coordinate_units IS NOT NULL AND kills % 6 <> 0")
def finite_features(spark, sf_dir):
    """Rows with a null, infinite or NaN feature go."""
    g = _gold(spark, sf_dir).withColumn("kills", F.when(F.col("kills") % 6 == 0, F.lit(float("inf"))).otherwise(F.col("kills").cast("double")))
    return validate.finite_features(g).select("match_id", "player_id", F.col("kills").cast("bigint").alias("kills"))


@query(f"{_GOLD} SELECT match_id, player_id, CAST(short_kill_interval_count >= 2 AS INTEGER) AS is_suspicious FROM gold WHERE minimum_kill_interval_seconds IS NOT NULL AND median_kill_distance_coordinate_units IS NOT NULL AND kills % 4 <> 0")
def labeled_rows(spark, sf_dir):
    """P19."""
    label = F.when(F.col("kills") % 4 != 0, (F.col("short_kill_interval_count") >= 2).cast("int"))
    return validate.labeled_rows(_gold(spark, sf_dir).withColumn("is_suspicious", label)).select("match_id", "player_id", "is_suspicious")


@query(f"{_GOLD} SELECT count(*) AS rows, 0::BIGINT AS differing FROM gold WHERE minimum_kill_interval_seconds IS NOT NULL AND median_kill_distance_coordinate_units IS NOT NULL")
def mllib_scores(spark, sf_dir):
    """D-1: a fitted MLlib model's scores against its coefficients written out as an expression."""
    rows = validate.finite_features(_gold(spark, sf_dir)).withColumn("features", F.array(*S.FEATURES)).withColumn("label", (F.col("short_kill_interval_count") >= 2).cast("double"))
    model = LogisticRegression(featuresCol="_x", maxIter=20, regParam=0.01).fit(rows.withColumn("_x", array_to_vector("features")))
    plain = scoring.score_logistic([float(w) for w in model.coefficients], float(model.intercept), [F.col("features")[i] for i in range(5)])
    scored = scoring.score_model(rows.withColumn("plain", plain), model)
    far = (F.abs(F.col("risk_score") - F.col("plain")) > 1e-5) | F.isnan("risk_score") | ~F.col("risk_score").between(0, 1)
    return scored.agg(F.count("*").alias("rows"), F.count_if(far).alias("differing"))


@query(f"""{_SERVED} SELECT match_id, player_id, sha256(match_id || '|' || player_id || '|v1') AS prediction_id, 'v1' AS model_version, level AS risk_level, fs AS features, sizes AS contributions, '2026-07-28T02:30:00Z' AS scored_at FROM sv WHERE NOT bad""")
def contract_predictions(spark, sf_dir):
    """D-10."""
    c = scoring.to_contract_prediction(served(spark, sf_dir), now())
    return c.select("match_id", "player_id", "prediction_id", "model_version", "risk_level", _shown(F.col("evidence")).alias("features"), _shown(F.col("evidence"), "contribution").alias("contributions"), "scored_at")


@query(f"{_SERVED} SELECT match_id, player_id, texts AS reasons FROM sv WHERE NOT bad")
def evidence_reasons(spark, sf_dir):
    """2.8: the items' texts, two decimals and one for z."""
    return served(spark, sf_dir).where("status = 'OK'").select("match_id", "player_id", _shown(F.col("evidence"), "reason").alias("reasons"))


@query(f"{WITH_STATS}, x AS (SELECT *, NULL::DOUBLE AS lobby, row_number() OVER () AS rid FROM ({_RATES})), {EVIDENCE_ITEMS}, h AS (SELECT rid, rz FROM t WHERE f = 'headshot_ratio') SELECT event_id, l_partkey, player_id, round(coalesce(rz, 0)::DOUBLE, 1) AS z FROM x LEFT JOIN h USING (rid)")
def headshot_z(spark, sf_dir):
    """2.8: the headshot item found by name among the two kept, else 0."""
    r = features.rate_features(A.stats(spark, sf_dir))
    return r.select("event_id", "l_partkey", "player_id", F.round(decision.headshot_z(evidence.evidence(_named(r))), 1).alias("z"))


@query("""SELECT l_linenumber + 5 AS size, coalesce(CASE WHEN l_linenumber + 5 < 10 THEN NULL WHEN (l_discount * 10)::FLOAT > 0.8::FLOAT THEN 'heuristic_teleport_hack' WHEN l_quantity >= 2 AND l_partkey > 0 AND l_partkey < 200 THEN 'heuristic_burst_aimbot'
WHEN l_linenumber + 5 > 10 AND l_suppkey % 9 >= 5 THEN 'heuristic_headshot_streak' END, 'none') AS policy_rule, count(*) AS n FROM lineitem GROUP BY 1, 2""")
def heuristics_by_position(spark, sf_dir):
    """D-6 and 2.8: arrays of 6 to 12 values; under ten no rule holds, the eleventh is 0 where it is missing."""
    every = F.array(F.col("l_quantity"), *(F.lit(0.0) for _ in range(7)), F.col("l_partkey").cast("double"), F.col("l_discount") * 10, (F.col("l_suppkey") % 9).cast("double"), F.lit(0.0))
    size = F.col("l_linenumber") + 5
    rule = decision.heuristics_by_position(F.slice(every, F.lit(1), size))
    return A.table(spark, sf_dir, "lineitem").groupBy(size.alias("size"), F.coalesce(rule["policy_rule"], F.lit("none")).alias("policy_rule")).agg(F.count("*").alias("n"))


# -- reports --------------------------------------------------------------------


@query(f"{_GOLD} SELECT match_id, player_id, kills::DOUBLE AS kills, coalesce(minimum_kill_interval_seconds, 0) AS minimum_kill_interval_seconds, short_kill_interval_count::DOUBLE AS short_kill_interval_count FROM gold WHERE player_id = 'u1'")
def player_profile(spark, sf_dir):
    """P22."""
    return reports.player_profile(_gold(spark, sf_dir), "u1", ["kills", "minimum_kill_interval_seconds", "short_kill_interval_count"])


@query("SELECT 'o' || o_orderkey AS path FROM orders ORDER BY o_orderdate DESC, 'o' || o_orderkey DESC LIMIT 1")
def newest_object(spark, sf_dir):
    """Orders as objects, their dates as times of change."""
    return reports.newest_object(A.table(spark, sf_dir, "orders").select(F.concat(F.lit("o"), _text("o_orderkey")).alias("path"), F.col("o_orderdate").alias("modified")))


@query("SELECT c_custkey, c_name FROM customer ORDER BY c_nationkey, c_custkey LIMIT 100")
def sample_rows(spark, sf_dir):
    """The report's first 100 rows."""
    return reports.sample_rows(A.table(spark, sf_dir, "customer"), ["c_nationkey", "c_custkey"], 100).select("c_custkey", "c_name")


@query("WITH e AS (SELECT user_id, event_id, ts FROM events) SELECT player_id, count(*) AS rows FROM (SELECT 'player_suspect_' || user_id AS player_id FROM e WHERE event_id % 2 = 0 UNION ALL SELECT 'u' || user_id FROM e) GROUP BY 1 HAVING count(*) > 1")
def repeated_players(spark, sf_dir):
    """W5 over one key."""
    e = A.table(spark, sf_dir, "events")
    both = e.where("event_id % 2 = 0").select(F.concat(F.lit("player_suspect_"), _text("user_id")).alias("player_id")).unionAll(e.select(F.concat(F.lit("u"), _text("user_id"))))
    return quality.duplicate_keys(both, ["player_id"]).withColumnRenamed("n", "rows")


# -- scalar functions --------------------------------------------------------------

_COMMON = """c AS (SELECT event_id AS i, CASE WHEN event_id % 7 = 0 THEN 'short' WHEN event_id % 7 = 1 THEN '  ' ELSE 'ok' END AS id_kind FROM events)"""


@query(f"""WITH {_COMMON} SELECT reason, count(*) AS records FROM (SELECT 'event_id_blank' AS reason FROM c WHERE id_kind = '  ' UNION ALL SELECT 'event_id_not_sha256' FROM c WHERE id_kind = 'short' UNION ALL SELECT 'match_id_too_long' FROM c WHERE i % 11 = 0
UNION ALL SELECT 'player_id_blank' FROM c WHERE i % 3 = 0 UNION ALL SELECT 'schema_version_unknown' FROM c WHERE i % 13 = 0 UNION ALL SELECT 'ingest_time_invalid' FROM c WHERE i % 5 = 0 UNION ALL SELECT 'event_time_invalid' FROM c WHERE i % 17 = 0) GROUP BY 1""")
def validate_common(spark, sf_dir):
    """P11, with ids of over 256 bytes but under 256 characters."""
    i = F.col("event_id")
    e = A.table(spark, sf_dir, "events").select(
        F.when(i % 7 == 0, "short").when(i % 7 == 1, " \t ").otherwise(F.upper(F.sha2(_text("event_id"), 256))).alias("event_id"), F.when(i % 11 == 0, F.repeat(F.lit("é"), 200)).otherwise("m").alias("match_id"),
        F.when(i % 3 == 0, " ").otherwise(F.repeat(F.lit("p"), 256)).alias("player_id"), F.when(i % 13 == 0, "2.0").otherwise("1.0").alias("schema_version"),
        F.when(i % 5 == 0, "2026-01-01").otherwise("2026-01-01T00:00:00.5+07:00").alias("ingest_time"), F.when(i % 17 == 0, "yesterday").when(i % 17 == 1, "2026-01-01T00:00:00Z").alias("event_time"),
    )
    return validate.validate_common(e).select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("records"))


@query("""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN true WHEN 1 THEN true ELSE false END AS hex64, CAST(CASE c_custkey % 4 WHEN 3 THEN 128 WHEN 2 THEN 63 ELSE 64 END AS INTEGER) AS bytes, left(sha256(c_name), 8) AS eight, left(sha256(c_name), 12) AS twelve FROM customer""")
def hex_and_bytes(spark, sf_dir):
    """2.8: 64 hex digits in any case, byte lengths, prefixes."""
    k, h = F.col("c_custkey") % 4, F.sha2("c_name", 256)
    c = A.table(spark, sf_dir, "customer").select("c_custkey", h.alias("h"), F.when(k == 0, h).when(k == 1, F.upper(h)).when(k == 2, F.substring(h, 1, 63)).otherwise(F.repeat(F.lit("é"), 64)).alias("id"))
    return c.select("c_custkey", E.is_hex64("id").alias("hex64"), F.octet_length("id").alias("bytes"), F.substring("h", 1, 8).alias("eight"), F.substring("h", 1, 12).alias("twelve"))


@query("""SELECT CAST(o_orderkey % 6 AS INTEGER) AS form, o_orderkey % 6 IN (0, 2, 5) AS valid, count(*) AS n FROM orders GROUP BY 1, 2""")
def rfc3339_checks(spark, sf_dir):
    """2.8: a full date-time with zone; no bare date, no thirteenth month, no missing zone."""
    k = F.col("o_orderkey") % 6
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    t = F.when(k == 0, F.concat(day, F.lit("T10:20:30Z"))).when(k == 1, day).when(k == 2, F.concat(day, F.lit("T10:20:30.123+07:00"))).when(k == 3, F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("-13-01T10:20:30Z"))).when(k == 4, F.concat(day, F.lit("T10:20:30"))).otherwise(F.concat(day, F.lit(" 10:20:30-00:30")))
    return A.table(spark, sf_dir, "orders").groupBy(k.cast("int").alias("form"), E.is_rfc3339(t).alias("valid")).agg(F.count("*").alias("n"))


@query("SELECT strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month, strftime(o_orderdate, '%d') AS day, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS stamp, count(*) AS n FROM orders GROUP BY 1, 2, 3, 4")
def date_parts(spark, sf_dir):
    """2.8: the lake's folder parts and the RFC 3339 form (in UTC)."""
    at = F.col("o_orderdate").cast("timestamp_ntz")
    stamp = F.concat(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    return A.table(spark, sf_dir, "orders").groupBy(*E.date_parts(at), stamp.alias("stamp")).agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, replace(o_orderpriority || '/' || o_orderkey || '/x', '/', '-') AS slug FROM orders")
def slugs(spark, sf_dir):
    """2.8."""
    return A.table(spark, sf_dir, "orders").select("o_orderkey", E.slug(F.concat(F.lit(" "), "o_orderpriority", F.lit("/"), _text("o_orderkey"), F.lit("/x\t　"))).alias("slug"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN q < 0 THEN 0 - floor(-q + 0.5) ELSE floor(q + 0.5) END AS whole, CASE WHEN q < 0 THEN 0 - floor(-q * 10 + 0.5) ELSE floor(q * 10 + 0.5) END / 10 AS tenth, coalesce(l_partkey::DOUBLE / nullif(l_suppkey % 7, 0), -1.0::DOUBLE) AS ratio FROM (SELECT *, ((l_orderkey % 80) - 40) / 4.0::DOUBLE AS q FROM lineitem)")
def rounding(spark, sf_dir):
    """2.8: halves away from zero; division with a default."""
    q = ((F.col("l_orderkey") % 80) - 40) / F.lit(4.0)
    return A.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", E.half_away(q, 0).alias("whole"), E.half_away(q, 1).alias("tenth"), E.ratio(F.col("l_partkey").cast("double"), (F.col("l_suppkey") % 7).cast("double"), -1.0).alias("ratio"))


@query("""SELECT doc_id, regexp_replace(regexp_replace(text, '^[\\s\\p{Z}\\x{0085}\\x0B]+', ''), '[\\s\\p{Z}\\x{0085}\\x0B]+$', '') AS trimmed, sha256(text) AS sha FROM documents""")
def trim_and_sha(spark, sf_dir):
    """2.8 over whole texts; null gives null."""
    return A.table(spark, sf_dir, "documents").select("doc_id", E.trimmed("text").alias("trimmed"), E.sha256("text").alias("sha"))


@query("""SELECT event_id, CASE event_id % 8 WHEN 0 THEN event_id WHEN 1 THEN -event_id WHEN 2 THEN event_id END AS whole, CASE event_id % 8 WHEN 0 THEN event_id::DOUBLE WHEN 1 THEN -event_id::DOUBLE WHEN 2 THEN event_id::DOUBLE WHEN 3 THEN event_id + 0.5::DOUBLE WHEN 4 THEN event_id * 100.0::DOUBLE END AS number FROM events""")
def strict_casts(spark, sf_dir):
    """2.8: plain notation only: no "4d", no "NaN", no white space inside, no hexadecimal."""
    i, s = F.col("event_id") % 8, _text("event_id")
    t = F.when(i == 0, s).when(i == 1, F.concat(F.lit(" -"), s, F.lit(" "))).when(i == 2, F.concat(F.lit("+"), s)).when(i == 3, F.concat(s, F.lit(".5"))).when(i == 4, F.concat(s, F.lit("e2"))).when(i == 5, F.concat(s, F.lit("d"))).when(i == 6, "NaN").otherwise(F.concat(F.lit("0x"), s))
    return A.table(spark, sf_dir, "events").select("event_id", E.parse_long(t).alias("whole"), E.parse_double(t).alias("number"))
