"""What a micro-batch leaves on disk while it runs and afterwards."""

import os

from pyspark.sql import functions as F

from matchguard.sources import lake
from matchguard.streaming import pipeline


def shuffle_files(spark):
    """Names of the shuffle files that lie on this machine's disk."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_batch_holds_no_shuffle_files_or_cached_rows_of_its_earlier_steps(spark, tmp_path, monkeypatch):
    """F3."""
    from test_normalize_validate import BASE, KILL, messages

    m = messages(spark, [BASE, KILL]).withColumn("timestamp", F.lit("2026-07-28 10:00:00").cast("timestamp"))
    root, seen, commit = f"file://{tmp_path}/lake", [], lake.commit
    before, cached = shuffle_files(spark), spark.sparkContext._jsc.sc().getPersistentRDDs().size()

    def at_commit(*args):
        seen.append((shuffle_files(spark) - before, spark.sparkContext._jsc.sc().getPersistentRDDs().size() - cached))
        commit(*args)

    monkeypatch.setattr(lake, "commit", at_commit)
    done = pipeline.process_batch(m, root)
    assert done is not None and seen == [(set(), 0)]
    assert os.listdir(tmp_path / "lake" / "_work") == []
    assert lake.current(spark, root, "gold").count() > 0
