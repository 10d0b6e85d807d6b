"""A batch's messages are parsed once, whatever reads them."""

from pyspark.sql import functions as F

from matchguard.operators import envelope
from matchguard.streaming import pipeline


def test_each_text_is_parsed_once_a_shape(spark):
    from test_normalize_validate import BASE, KILL, messages

    parsed = envelope.parse_envelopes(messages(spark, [BASE, KILL, b"\xff"]))
    for df in (envelope.envelopes(parsed), envelope.malformed(parsed)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") <= 2, plan


def test_messages_are_judged_in_one_table(spark):
    from test_normalize_validate import BASE, KILL, messages

    bad = BASE | {"event_id": "short"}
    rows = pipeline._judged(messages(spark, [BASE, BASE, KILL, bad, bad, b"\xff", b""]), 1 << 20).orderBy("offset").collect()
    assert [r["status"] for r in rows] == ["valid", "valid", "valid", "invalid", "invalid", "malformed", "malformed"]
    assert sum(r["duplicate"] for r in rows) == len({r["offset"] for r in rows if r["status"] == "valid"}) - len({r["event_id"] for r in rows if r["status"] == "valid"})
    assert [r["value"] is None for r in rows[:6]] == [True] * 5 + [False]


def test_gaps_are_counted_on_both_sides(spark):
    from matchguard.plans.queries import gaps

    df = lambda *v: spark.createDataFrame([(x,) for x in v], "x int")
    assert {r["side"]: r["rows"] for r in gaps(df(1, 1, 2, None), df(1, 3, None), ["x"]).collect()} == {"stream_only": 2, "batch_only": 1, "streamed": 4}
