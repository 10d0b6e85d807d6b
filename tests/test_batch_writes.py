"""A batch goes to its folder without a sort of its rows by day and batch."""

from matchguard.plans import adapters as A
from matchguard.sources import readers, sinks
from pyspark.sql import functions as F

CONF = "spark.sql.maxConcurrentOutputFileWriters"


def test_bronze_is_written_unsorted_and_replaces_only_itself(spark, tmp_path):
    b, path = A.bronze(spark, "/root/testdata/sf0.001"), str(tmp_path / "bronze")
    day = F.when(F.col("op").endswith("raw"), "2026-07-28").otherwise("2026-07-29").cast("timestamp")
    before, store = spark.conf.get(CONF, None), spark._jsparkSession.sharedState().statusStore()
    n = store.executionsCount()
    for batch in ("b1", "b2", "b1"):
        sinks.write_bronze(b, path, batch, day)
    made = [store.executionsList().apply(i).physicalPlanDescription() for i in range(n, store.executionsCount())]
    made = [plan for plan in made if "InsertIntoHadoopFsRelationCommand" in plan]
    assert len(made) == 3 and not any("Sort" in plan for plan in made)
    assert spark.conf.get(CONF, None) == before
    assert readers.read_bronze(spark, path).count() == 2 * b.count()
    # more partitions than a task holds open: the rest is sorted, nothing is lost
    every = F.expr("timestamp '2026-01-01' + make_interval(0, 0, 0, cast(pmod(hash(event_id), 20) as int))")
    sinks.write_bronze(b, str(tmp_path / "days"), "b1", every)
    assert readers.read_bronze(spark, str(tmp_path / "days")).count() == b.count()
    assert len(list((tmp_path / "days").glob("*/*/*"))) == 20
