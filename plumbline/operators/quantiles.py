"""Exact quantiles of many values, without a task that sees all of them."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .graphs import written


def quantiles(df: DataFrame, keys: list[str], value: str, shares: list[float], weight: str | None = None) -> DataFrame:
    """(keys, q): Spark's `percentile` of a column for few groups, q an array of doubles in the order of shares.

    Different values are counted and dealt in order over slices, the partitions of a shuffle; the sums of the slices tell
    which ones hold the wanted ranks, and only those are looked into.  weight says how often a row counts.
    Nulls are left out, and rows of a null key; a group without a value has no row.
    """
    n = F.count("*") if weight is None else F.sum(weight)
    there = reduce(and_, [F.col(c).isNotNull() for c in (*keys, "v")])
    counts = df.select(*keys, F.col(value).cast("double").alias("v"), *([weight] if weight else [])).where(there).groupBy(*keys, "v").agg(n.alias("n"))
    dealt = written(counts.repartitionByRange(*keys, "v").withColumn("slice", F.spark_partition_id()))
    sums = dealt.groupBy(*keys, "slice").agg(F.sum("n").alias("n"))
    upto = F.sum("n").over(Window.partitionBy(*keys).orderBy("slice"))
    sums = sums.withColumn("total", F.sum("n").over(Window.partitionBy(*keys))).withColumn("before", upto - F.col("n"))
    places = [(F.col("total") - 1) * F.lit(float(p)) for p in shares]
    ranks = [f(p).cast("long") for p in places for f in (F.floor, F.ceil)]
    among = lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("n"))
    wanted = sums.where(reduce(or_, [among(r) for r in ranks])).select(*keys, "slice", "before", "total")
    x = dealt.join(F.broadcast(wanted), [*keys, "slice"])  # two slices a share and group at most
    x = x.withColumn("before", F.col("before") + F.sum("n").over(Window.partitionBy(*keys, "slice").orderBy("v")) - F.col("n"))
    x = x.groupBy(*keys, "total").agg(*[F.max(F.when(among(r), F.col("v"))).alias(f"v{i}") for i, r in enumerate(ranks)])
    low, high = ([F.col(f"v{2 * i + k}") for i in range(len(shares))] for k in (0, 1))
    between = [F.when(a == b, a).otherwise((F.ceil(p) - p) * a + (p - F.floor(p)) * b) for a, b, p in zip(low, high, places, strict=True)]
    return x.select(*keys, F.array(*between).alias("q"))
