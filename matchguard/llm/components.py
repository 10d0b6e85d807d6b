"""Connected components of an edge table, wholly in Spark.

Rounds of large-star and small-star steps, after a union-find inside each
partition that thins the edges; every step is written to the shared folder, so
a lost executor repeats one step only. Edges never reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the edges and, for each, the smallest node that it reaches."""
    nodes, codes = np.unique(np.concatenate([a, b]), return_inverse=True)
    up, x, y = np.arange(len(nodes)), codes[: len(a)], codes[len(a) :]
    while True:  # hooking and pointer jumping on arrays
        px, py = up[x], up[y]
        lo, hi = np.minimum(px, py), np.maximum(px, py)
        if (lo == hi).all():
            return nodes, nodes[up]
        np.minimum.at(up, hi, lo)
        while True:
            higher = up[up]
            if (higher == up).all():
                break
            up = higher


def _thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b, held = [], [], 0

    def out() -> pa.RecordBatch:
        nodes, root = roots(np.concatenate(a), np.concatenate(b))
        keep = nodes != root
        return pa.RecordBatch.from_arrays([pa.array(nodes[keep]), pa.array(root[keep])], names=["a", "b"])

    for batch in batches:
        if batch.num_rows:
            a.append(batch.column(0).to_numpy())
            b.append(batch.column(1).to_numpy())
            held += batch.num_rows
            if held > 1 << 20:
                kept = out()
                yield kept
                a, b, held = [], [], 0
    if held:
        yield out()


def _star_shaped(edges: DataFrame) -> bool:
    """Every node hangs on one root and no root hangs on a node."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("v"), F.lit(1).alias("child"), F.lit(0).alias("root")), F.struct(F.col("b").alias("v"), F.lit(0).alias("child"), F.lit(1).alias("root")))).alias("e")).select("e.*")
    bad = ends.groupBy("v").agg(F.sum("child").alias("child"), F.max("root").alias("root")).where((F.col("child") > 1) | (F.col("child") >= 1) & (F.col("root") == 1))
    return not bad.head(1)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node, component`` of every node that has an edge; component is the smallest node reached.

    ``edges`` has two long columns, any names; null ends and loops are ignored.
    """
    a, b = edges.columns[:2]
    clean = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a is not null and b is not null and a <> b")
    now = materialize(clean.mapInArrow(_thin, "a long, b long"), name)
    while True:
        if _star_shaped(now):
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        # large-star: each node passes its smallest neighbour to its larger neighbours
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # small-star: and then to its smaller ones
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        after = materialize(small.mapInArrow(_thin, "a long, b long"), name)
        discard(now)
        now = after
