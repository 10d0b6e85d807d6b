"""z in plain notation with one decimal, as the queries' SQL prints it."""

import struct

from matchguard.functions.expr import one_decimal
from matchguard.plans import queries as Q
from pyspark.sql import functions as F


def single(x: float) -> float:
    return struct.unpack("f", struct.pack("f", x))[0]


def test_z_is_printed_in_plain_notation_at_any_size(spark):
    values = [single(x) for x in (1.6, 2.0, 70467.9, 999999.9, 1000000.1, 1500000.1, 2500000.25, 2500000.75, 9999999.0, 1.1808092e7, 3.2e9)]
    rows = spark.createDataFrame([(v,) for v in values], "v float").select("v", one_decimal(F.col("v")).alias("t")).collect()
    assert [r["t"] for r in rows] == [f"{v:.1f}" for v in values]


def test_large_part_keys_give_plain_z(spark, tmp_path):
    one = spark.createDataFrame([(1800000, 1200000, 3, 1, 50.0, 90000.0, 0.1, 0.08)], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double")
    one.write.parquet(str(tmp_path / "lineitem.parquet"))
    z = Q.QUERIES["evidence_top2"](spark, str(tmp_path)).head()["z_scores"]
    assert "E" not in z and float(z.split("|")[0]) > 1e7


def test_predictions_print_large_z_alike(spark):
    items = F.array(*(F.struct(F.lit(v).cast("float").alias("z_score")) for v in (1.1978093e7, 2500000.25, 1.6)))
    assert spark.range(1).select(Q._shown(items, "z").alias("z")).head()["z"] == "11978093.0|2500000.2|1.6"
