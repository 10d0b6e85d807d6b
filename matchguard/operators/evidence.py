"""Robust-z evidence (D-4, D-5, T1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S

#: Reference medians and median absolute deviations, in feature order.
MEDIANS = [0.15, 120.0, 0.18, 100.0, 150.0, 200.0]
MADS = [0.08, 45.0, 0.08, 30.0, 40.0, 80.0]
#: The names in the same order, the normal-consistency factor and the least z of an item.
POSITIONAL = S.EVIDENCE_FEATURES
MAD_FACTOR, LEAST_Z, KEEP = 1.4826, 1.5, 2


def robust_z(x: Column, median: Column, mad: Column) -> Column:
    """(x - median) / (MAD * 1.4826) in single precision; null for a MAD of 0."""
    f = lambda c: c.cast("float")
    return F.try_divide(f(x) - f(median), f(mad) * F.lit(MAD_FACTOR).cast("float")).cast("float")


Item = tuple[str, Column, Column, Column]


_ITEM = "struct<feature:string,value:float,lobby_avg:float,z_score:float,reason:string>"


def top_evidence(items: list[Item], keep: int = KEEP, reasons: bool = True) -> Column:
    """Items (name, value, median, MAD) with z over 1.5 by falling rounded z, ties in feature order, the first ``keep`` (0: all).

    Only numbers are sorted and cut; names and texts (unless not ``reasons``) are
    made for the items that stay. Each z is written once, so the plan grows with the number of items only.
    """
    if not items:
        return F.array().cast(f"array<{_ITEM}>")
    ten = F.lit(10.0).cast("float")
    numbers = []
    for i, (_, x, median, mad) in enumerate(items):
        z = robust_z(x, median, mad)
        rounded = (F.floor((z * ten).cast("double") + 0.5) / 10).cast("float")  # half up; z is positive where it counts
        numbers.append(F.when(z > LEAST_Z, F.struct(rounded.alias("rounded"), F.lit(-i).alias("at"), x.cast("float").alias("value"), median.cast("float").alias("lobby_avg"), z.alias("z"))))
    found = F.sort_array(F.array(*numbers), asc=False)  # nulls come last
    names = F.array(*(F.lit(name) for name, *_ in items))

    def shown(e: Column) -> Column:
        name = names[-e["at"]]
        text = F.format_string("%s %.2f against %.2f in the lobby (+%.1f sigma)", name, e["value"].cast("double"), e["lobby_avg"].cast("double"), e["z"].cast("double"))
        reason = text if reasons else F.lit(None).cast("string")
        return F.struct(name.alias("feature"), e["value"].alias("value"), e["lobby_avg"].alias("lobby_avg"), e["rounded"].alias("z_score"), reason.alias("reason"))

    return F.transform(F.array_compact(F.slice(found, 1, keep) if keep else found), shown)


def evidence(named: dict[str, Column] | None = None, positional: Column | None = None, keep: int = KEEP, reasons: bool = True) -> Column:
    """D-4 against the fixed medians and MADs; features by name, or by place in an array."""
    if named is None:
        if positional is None:
            raise ValueError("give named features or an array")
        named = {n: F.get(positional, F.lit(i)) for i, n in enumerate(POSITIONAL)}
    items = [(n, named[n], F.lit(m), F.lit(d)) for n, m, d in zip(POSITIONAL, MEDIANS, MADS, strict=True) if n in named]
    return top_evidence(items, keep, reasons)


def evidence_from_lobby(df: DataFrame, cols: list[str] | None = None, keep: int = KEEP) -> DataFrame:
    """D-5: medians and MADs of each match, in two grouped passes. ``cols`` defaults to the rate features' columns."""
    cols = [S.EVIDENCE_COLUMNS.get(c, c) for c in S.EVIDENCE_FEATURES] if cols is None else cols
    medians = df.groupBy("match_id").agg(*(F.percentile(c, F.lit(0.5)).alias(f"_m_{c}") for c in cols))
    with_m = df.join(medians, "match_id")
    mads = with_m.groupBy("match_id").agg(*(F.percentile(F.abs(F.col(c) - F.col(f"_m_{c}")), F.lit(0.5)).alias(f"_d_{c}") for c in cols))
    items = [(c, F.col(c), F.col(f"_m_{c}"), F.col(f"_d_{c}")) for c in cols]
    return with_m.join(mads, "match_id").withColumn("evidence", top_evidence(items, keep)).drop(*(f"_{k}_{c}" for k in "md" for c in cols))
