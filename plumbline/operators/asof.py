"""Joins on nearest times, each with its tie rule as a parameter."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def bracket(left: DataFrame, right: DataFrame, by: str, t: str, id_: str, value: str) -> DataFrame:
    """left(by, t, id) with the rows of right at or before and after it: (before, after) as structs (t, id, value).

    Both sides are one stream sorted by time, so the cost is one shuffle and one sort; no
    pairs are made.  Of rows at one time the one with the larger id is the nearer.
    """
    none = F.lit(None)
    kind = right.select(F.struct(t, id_, value).alias("r")).schema["r"].dataType
    a = left.select(by, t, F.col(id_).alias("__id"), F.lit(1).alias("__side"), none.cast(kind).alias("__r"))
    b = right.select(by, t, F.col(id_).alias("__id"), F.lit(0).alias("__side"), F.struct(t, id_, value).alias("__r"))
    order = Window.partitionBy(by).orderBy(t, "__side", "__id")
    before = F.last("__r", True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first("__r", True).over(order.rowsBetween(1, Window.unboundedFollowing))
    rows = a.unionByName(b).withColumn("before", before).withColumn("after", after)
    return rows.where("__side = 1").select(by, t, F.col("__id").alias(id_), "before", "after")


def nearest(left: DataFrame, right: DataFrame, by: str, t: str, id_: str, value: str, ties: str = "earlier", tolerance: float | None = None) -> DataFrame:
    """(by, t, id, match_id, match_t, match_value): the nearest row of right; none beyond the tolerance.

    ties: "earlier" or "later", which of two equally near rows to take.
    """
    rows = bracket(left, right, by, t, id_, value)
    back, ahead = F.col(t) - F.col(f"before.{t}"), F.col(f"after.{t}") - F.col(t)
    first = back <= ahead if ties == "earlier" else back < ahead
    hit = F.when(F.col("after").isNull() | first, F.col("before")).otherwise(F.col("after"))
    rows = rows.withColumn("hit", hit).where("hit is not null")
    if tolerance is not None:
        rows = rows.where(F.abs(F.col(f"hit.{t}") - F.col(t)) <= tolerance)
    return rows.select(by, t, id_, F.col(f"hit.{id_}").alias("match_id"), F.col(f"hit.{t}").alias("match_t"), F.col(f"hit.{value}").alias("match_value"))


def resample(targets: DataFrame, samples: DataFrame, by: str, t: str, id_: str, value: str, max_gap: float) -> DataFrame:
    """(by, t, id, value): linear between the samples around each target.

    A target outside its samples or in a gap above max_gap has none.
    """
    rows = bracket(targets, samples, by, t, id_, value)
    t0, t1, v0, v1 = F.col(f"before.{t}"), F.col(f"after.{t}"), F.col(f"before.{value}"), F.col(f"after.{value}")
    exact = F.abs(F.col(t) - t0) <= 1e-8
    found = F.when(exact, v0).when(t1 - t0 <= max_gap, v0 + (v1 - v0) * (F.col(t) - t0) / (t1 - t0))
    return rows.select(by, t, id_, found.alias("value")).where("value is not null")
