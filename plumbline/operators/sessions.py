"""Visits: runs of observations without a long gap, and what they show of drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def visits(df: DataFrame, key: str, t: str, gap: float, tie: str) -> DataFrame:
    """Adds `visit`, counting from 0 per key; a new one starts where t jumps by more than gap."""
    order = Window.partitionBy(key).orderBy(t, tie)
    jump = F.when(F.col(t) - F.lag(t).over(order) > gap, 1).otherwise(0)
    return df.withColumn("visit", F.sum(jump).over(order.rowsBetween(Window.unboundedPreceding, 0)))


def visit_offsets(df: DataFrame, key: str, t: str, value: str, gap: float, least: int, tie: str) -> DataFrame:
    """(key, visit, median, mean, n) of visits with at least `least` observations."""
    found = visits(df, key, t, gap, tie).groupBy(key, "visit")
    return found.agg(F.median(value).alias("median"), F.avg(value).alias("mean"), F.count("*").alias("n")).where(F.col("n") >= least)


def drift(df: DataFrame, key: str, t: str, value: str, gap: float, least: int, tie: str) -> DataFrame:
    """(key, n_visits, spread, std) of keys visited twice or more; spread is the range of visit medians."""
    found = visit_offsets(df, key, t, value, gap, least, tie).groupBy(key)
    found = found.agg(F.count("*").alias("n_visits"), (F.max("median") - F.min("median")).alias("spread"), F.stddev_pop("median").alias("std"))
    return found.where("n_visits >= 2")


def drift_summary(drifts: DataFrame) -> DataFrame:
    """Median, 90th percentile and largest of the spreads."""
    return drifts.agg(F.count("*").alias("n_tracks"), F.median("spread").alias("median_spread"), F.percentile("spread", 0.9).alias("p90_spread"), F.max("spread").alias("max_spread"))


def refit_offsets(df: DataFrame, key: str, t: str, value: str, offset: Column, band: float, gap: float, least: int, tie: str) -> DataFrame:
    """(key, old_offset, new_offset, refitted): the median of visit medians replaces an offset it is near to."""
    new = visit_offsets(df, key, t, value, gap, least, tie).groupBy(key).agg(F.median("median").alias("found"))
    old = df.groupBy(key).agg(offset.alias("old_offset"))
    out = old.join(new, key, "left")
    good = F.coalesce(F.abs(F.col("found") - F.col("old_offset")) <= band, F.lit(False))
    return out.select(key, "old_offset", F.when(good, F.col("found")).otherwise(F.col("old_offset")).alias("new_offset"), good.alias("refitted"))


def contiguous_runs(df: DataFrame, key: str, position: str, gap: float, least: int = 2) -> DataFrame:
    """(key, low, high, n): sorted positions split where they leave a gap; runs of `least` or more."""
    order = Window.partitionBy(key).orderBy(position)
    jump = F.when(F.col(position) - F.lag(position).over(order) > gap, 1).otherwise(0)
    runs = df.withColumn("run", F.sum(jump).over(order.rangeBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(key, "run").agg(F.min(position).alias("low"), F.max(position).alias("high"), F.count("*").alias("n")).where(F.col("n") >= least).drop("run")


def islands(df: DataFrame, key: str, cell: str, least: int) -> DataFrame:
    """(key, first, last) of runs of consecutive integer cells of `least` or more."""
    x = df.select(key, cell).distinct()
    x = x.withColumn("run", F.col(cell) - F.row_number().over(Window.partitionBy(key).orderBy(cell)))
    return x.groupBy(key, "run").agg(F.min(cell).alias("first"), F.max(cell).alias("last")).where(F.col("last") - F.col("first") + 1 >= least).drop("run")


def path_length(df: DataFrame, key: str, t: str, value: str, tie: str) -> DataFrame:
    """(key, length): summed steps between consecutive observations."""
    step = F.abs(F.col(value) - F.lag(value).over(Window.partitionBy(key).orderBy(t, tie)))
    return df.select(key, step.alias("step")).groupBy(key).agg(F.coalesce(F.sum("step"), F.lit(0.0)).alias("length"))
