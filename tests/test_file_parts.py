"""Rows of files that lie in parts are numbered on, without a shuffle where no line is missing."""

from matchguard.operators.normalize import with_record_index
from matchguard.plans import lake_queries as Q
from matchguard.sources.readers import read_raw_csv


def numbers(df):
    return sorted((r["record_index"], r["n"]) for r in df.collect())


def test_parts_follow_each_other_and_whole_blocks_are_not_shuffled(spark, tmp_path):
    folder = tmp_path / "file=1"
    folder.mkdir()
    for p in range(3):
        (folder / f"part-{p:05d}.csv").write_text("n,x\n" + "".join(f'{p * 10 + i},"a, b"\n' for i in range(10)))
    df = with_record_index(read_raw_csv(spark, str(tmp_path)), "file")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "hashpartitioning" not in plan
    assert numbers(df) == [(i + 1, str(i)) for i in range(30)]


def test_blocks_with_blank_lines_and_quoted_line_ends_are_numbered_alike(spark, tmp_path):
    folder = tmp_path / "file=1"
    folder.mkdir()
    (folder / "part-0.csv").write_text("n,x\n0,a\n\n \n1,\"b\nc\"\n2,d\n")
    (folder / "part-1.csv").write_text("n,x\n3,a\n4,b\n")
    (folder / "part-2.csv").write_text('n\n""\n"5,"\n" "\n6\n')
    found = numbers(with_record_index(read_raw_csv(spark, str(tmp_path)), "file"))
    assert found == [(1, "0"), (2, "1"), (3, "2"), (4, "3"), (5, "4"), (6, "5,"), (7, "6")]


def test_no_task_writes_a_whole_file(spark, tmp_path):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # four parts of a table as small as this
    try:
        df = read_raw_csv(spark, Q._csv_files(spark, "/root/testdata/sf0.001"))
        of_file = {(r["file"], r["source_path"]) for r in df.select("file", "source_path").distinct().collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert len(of_file) > len({f for f, _ in of_file}) == 7
