"""Reads of lake files that stay small at any file size."""

import json

from matchguard.sources import readers


def test_files_of_whole_lines_are_neither_read_whole_nor_joined(spark, tmp_path):
    for n in range(3):
        (tmp_path / f"{n}.json").write_text("".join(json.dumps({"event_id": f"{n}-{i}", "reasons": ["r"]}) + "\n" for i in range(50)))
    df = readers.read_invalid(spark, str(tmp_path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan and "Union" not in plan
    assert df.count() == 150


def test_only_the_files_with_an_object_over_lines_are_opened_whole(spark, tmp_path):
    for n in range(6):
        (tmp_path / f"{n}.json").write_text(json.dumps({"event_id": f"l{n}", "reasons": []}) + "\n")
    (tmp_path / "odd %41 [name].json").write_text(json.dumps([{"event_id": "a", "reasons": []}, {"event_id": "b", "reasons": []}], indent=2))
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))  # a file a task
    try:
        df = readers.read_invalid(spark, str(tmp_path))
        assert {r["event_id"] for r in df.collect()} == {*(f"l{n}" for n in range(6)), "a", "b"}
        assert df.rdd.getNumPartitions() == 7
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)


def test_a_bad_line_costs_no_other_line_and_no_line_is_parsed_only_to_be_told(spark, tmp_path):
    lines = ['{"event_id": "a", "reasons": []}', '{"event_id": }', ' [{"event_id": "b", "reasons": []}, {"event_id": "c", "reasons": []}]\t', "", '{"event_id": "d", "reasons": []}']
    (tmp_path / "one.json").write_text("\n".join(lines) + "\n")
    (tmp_path / "two.json").write_text('[{"event_id": "e", "reasons": []},\n{"event_id": "f", "reasons": []}]\n')
    (tmp_path / "three.json").write_text('{"raw_fields": {"x": "{"}\n, "event_id": "g", "reasons": []}\n')
    store = spark._jsparkSession.sharedState().statusStore()
    n = store.executionsCount()
    assert sorted(r["event_id"] for r in readers.read_invalid(spark, str(tmp_path)).collect() if r["event_id"]) == list("abcdefg")
    assert not any("try_parse_json" in store.executionsList().apply(i).physicalPlanDescription() for i in range(n, store.executionsCount()))
