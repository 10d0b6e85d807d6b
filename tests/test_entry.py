"""The entry points, with and without the corpus operators."""

import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_queries_stand_without_the_corpus_operators():
    code = "import sys; sys.modules['matchguard.llm'] = None; sys.modules['corpus_pipeline'] = None\nimport __spark_entry__ as e\nq = e.queries()\nassert len(q) > 50 and not any(k.startswith('op') or k == 'pipeline' for k in q) and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["gold_features", "player_match", "invalid_reason_breakdown", "batch_manifest", "predictions_full", "group_split", "average_precision", "evidence_top2", "event_ids", "record_index", "rejects_lake", "manifest_lake", "gold_signals", "model_registry", "invariants_broken", "describe_features"])
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("events", "lineitem", "labels", "nation"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    quoted = ", ".join(f'"{c}"' for c in cols)
    want = con.execute(f"select {quoted} from ({entry.oracle_sql()[name]})").fetchall()
    key = lambda r: tuple(repr(round(v, 9)) if isinstance(v, float) else repr(v) for v in r)
    assert sorted(map(key, (tuple(r[c] for c in cols) for r in df.collect()))) == sorted(map(key, want))
