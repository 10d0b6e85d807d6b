"""Envelopes are judged once, whatever reads the reasons."""

import re

from matchguard.functions.expr import blank, failed_codes, is_hex64, reasons, trimmed
from matchguard.operators import validate
from matchguard.plans import adapters as A
from pyspark.sql import functions as F


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_condition_on_the_reasons_does_not_make_an_envelope_again(spark):
    plan = plan_of(validate.validate_events(A.envelopes(spark, "/root/testdata/sf0.001")).select(F.explode("reasons")))
    assert plan.count("get_json_object") == 1  # the payload of a kill, by which its places were made again for each rule
    assert "filter(" not in plan and "array_compact" not in plan


def test_reasons_keep_their_order_and_leave_nulls_out(spark):
    rows = spark.createDataFrame([(1, "x"), (2, None), (None, "y")], "a int, code string")
    got = rows.select(reasons((F.col("a") >= 1, "one"), (F.col("a") >= 2, "two"), (F.lit(True), F.col("code"))).alias("r")).collect()
    assert [r["r"] for r in got] == [["one", "x"], ["one", "two"], ["y"]]


def test_blank_long_and_padded_ids_are_named(spark):
    good = "a" * 64
    rows = [(good, "m", "p"), (" \u2003", " " * 300, "p" * 257), ("zz", " " * 200 + "m" + " " * 200, " " + "p" * 256), (None, None, None)]
    df = spark.createDataFrame(rows, "event_id string, match_id string, player_id string").select("*", F.lit("1.0").alias("schema_version"), F.lit("2026-01-01T00:00:00Z").alias("ingest_time"), F.lit(None).cast("string").alias("event_time"))
    got = [r["reasons"] for r in validate.validate_common(df).select("reasons").collect()]
    assert got == [[], ["event_id_blank", "match_id_blank", "player_id_too_long"], ["event_id_not_sha256"], ["event_id_blank", "match_id_blank", "player_id_blank"]]


def test_rejects_are_picked_without_making_their_envelopes_again(spark):
    plan = plan_of(validate.invalid_envelopes(validate.validate_events(A.envelopes(spark, "/root/testdata/sf0.001"))))
    assert plan.count("get_json_object") == 1 and plan.count("sha2(concat(kill:") + plan.count("sha2(cast(concat(kill:") == 1


def test_rules_give_bits_and_codes_are_listed_behind_them(spark):
    judged = validate.validate_events(A.envelopes(spark, "/root/testdata/sf0.001"))
    plan = plan_of(validate.invalid_envelopes(judged))
    assert "_failed" in plan
    # a good envelope's ids are only looked at by length, by decoding and by their first character
    assert plan.count("btrim(") == plan.count("octet_length(btrim(")
    names = [c for _, c in (*validate.common_rules(), *validate.player_stat_rules(), *validate.kill_event_rules("kill."))]
    rows = spark.range(1 << 5).select((F.col("id") * 0x2020C041).alias("_failed")).withColumn("r", failed_codes("_failed", names)).collect()
    assert [r["r"] for r in rows] == [[c for i, c in enumerate(names) if r["_failed"] >> i & 1] for r in rows]


def test_compiled_methods_stay_below_the_size_that_the_jvm_compiles(spark, capsys):
    validate.invalid_envelopes(validate.validate_events(A.envelopes(spark, "/root/testdata/sf0.001"))).explain("codegen")
    sizes = [int(s) for s in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000


def test_quick_forms_of_blank_and_hex_equal_the_plain_ones(spark):
    odd = [None, "", "a" * 64, "a" * 64 + "\n", "a" * 64 + "\r\n", "a" * 63 + "\n", "A" * 63 + "g", "é" * 32, " " + "f" * 63, "　 ", "　x", "\x7f", "\x1f"]
    odd += ["1" * 63 + chr(i) for i in range(128)] + ["1" * 62 + chr(i) for i in range(128, 256)] + [chr(i) for i in range(256)] + [chr(i) + "x" for i in range(0x2000, 0x2070)]
    df = spark.createDataFrame([(v,) for v in odd], "v string")
    plain = F.coalesce(F.col("v").rlike("^[0-9A-Fa-f]{64}$"), F.lit(False))
    assert df.where((is_hex64("v") != plain) | (blank("v") != (trimmed("v") == ""))).collect() == []
