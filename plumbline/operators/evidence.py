"""Votes, classes, consensus and robust centres."""

from __future__ import annotations

import math
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graphs import checkpointed, written
from .joins import small
from .quantiles import quantiles


def votes(df: DataFrame, cell: list[str], weight: Column, confidence: Column, kind: str) -> DataFrame:
    """(cell, kind, weight, views, score): summed weight, rows and weighted confidence per cell and class."""
    return df.groupBy(*cell, kind).agg(F.sum(weight).alias("weight"), F.count("*").alias("views"), F.sum(weight * confidence).alias("score"))


def supported(df: DataFrame, cell: list[str], weight: Column, frame: str, least_views: int, least_weight: float, distinct_frames: bool = False) -> DataFrame:
    """Cells with enough views and weight. Views are rows, or different frames."""
    views = F.count_distinct(frame) if distinct_frames else F.count("*")
    return df.groupBy(*cell).agg(views.alias("views"), F.sum(weight).alias("weight")).where((F.col("views") >= least_views) & (F.col("weight") >= least_weight))


def _summed(x: Column) -> Column:
    """The sum of doubles, rounded once: parts on a grid of 2**-20 add exactly, and what is left of them is tiny, so the order of terms decides nothing."""
    grid = F.rint(x * 2.0**20) / 2.0**20
    return F.nanvl(F.sum(grid) + F.sum(x - grid), F.sum(x))  # infinite terms have no rest


def dominant_class(df: DataFrame, key: str, kind: str, weight: Column, share: float = 0.4, none: str | None = "water") -> DataFrame:
    """(key, top, second, dominant): `combined` if the second class has `share` of the first.

    A key without any class is water, as the rules have it, or `none`. Sums that differ by the order of their terms
    only are equal; of classes with equal sums the first by name leads, a null class last.
    """
    total = df.groupBy(key, kind).agg(_summed(weight.cast("double")).alias("w"))
    ranked = total.withColumn("r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("w"), F.asc_nulls_last(kind)))).where("r <= 2")
    out = ranked.groupBy(key).agg(*[F.max(F.when(F.col("r") == i, F.col(c))).alias(f"{c[0]}{i}") for i in (1, 2) for c in (kind, "w")])
    k = kind[0]
    combined = F.coalesce(F.col("w2") >= share * F.col("w1"), F.lit(False))
    return out.select(key, F.col(f"{k}1").alias("top"), F.col(f"{k}2").alias("second"), F.when(combined, "combined").otherwise(F.coalesce(f"{k}1", F.lit(none))).alias("dominant"))


def weighted_mode(df: DataFrame, key: str, value: str, weight: Column, order: str) -> DataFrame:
    """(key, mode): the value with most weight; of equals the one seen first by `order`. Nulls have no vote."""
    total = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.sum(weight).alias("w"), F.min(order).alias("o"))
    return total.groupBy(key).agg(F.max_by(value, F.struct("w", -F.col("o"))).alias("mode"))


def consensus(detections: DataFrame, region: str, damage_class: str, attributes: list[str]) -> DataFrame:
    """(region, class, attributes, confidence, frames, evidence) of each region and class.

    detections(region, class, weight, confidence, frame, evidence, place and attributes).  An attribute
    is the value with the largest sum of weight times confidence, the first by place among equals;
    nulls do not vote.  Frames are distinct and sorted, evidence is the first four by place.
    """
    by = [region, damage_class]
    out = detections.groupBy(*by).agg(
        F.avg("confidence").alias("confidence"),
        F.array_sort(F.collect_set("frame")).alias("frames"),
        F.transform(F.slice(F.array_sort(F.collect_list(F.when(F.coalesce("evidence", F.lit("")) != "", F.struct("place", "evidence")))), 1, 4), lambda e: e["evidence"]).alias("evidence"),
    )
    for a in attributes:
        tally = detections.where(F.col(a).isNotNull()).groupBy(*by, a).agg(F.sum(F.col("weight") * F.col("confidence")).alias("w"), F.min("place").alias("p"))
        out = out.join(tally.groupBy(*by).agg(F.max_by(a, F.struct("w", -F.col("p"))).alias(a)), by, "left")
    return out.select(*by, *attributes, "confidence", "frames", "evidence")


def combined_consensus(votes: DataFrame, tops: DataFrame, region: str, damage_class: str, attributes: list[str]) -> DataFrame:
    """The consensus of each region's first class, filled from its second where tops(region, top, second) name one.

    Confidence is the mean of both, frames their union, evidence the first four of both.
    """
    one, two = (tops.select(region, F.col(c).alias(damage_class)).join(votes, [region, damage_class], "left").select(region, F.struct(*attributes, "confidence", "frames", "evidence").alias(n)) for c, n in (("top", "a"), ("second", "b")))
    x = one.join(two, region)
    pick = [F.coalesce(f"a.{c}", f"b.{c}").alias(c) for c in attributes]
    both = F.col("b.confidence").isNotNull()
    frames = F.array_sort(F.array_union("a.frames", F.coalesce("b.frames", F.array().cast("array<int>"))))
    said = F.slice(F.concat("a.evidence", F.coalesce("b.evidence", F.array().cast("array<string>"))), 1, 4)
    return x.select(region, *pick, F.when(both, (F.col("a.confidence") + F.col("b.confidence")) / 2).otherwise(F.col("a.confidence")).alias("confidence"), frames.alias("frames"), said.alias("evidence"))


def refined_up(normals: DataFrame, key: str, n: list[str], hint: list[float], degrees: float = 25.0, least: int = 100) -> DataFrame:
    """(key, up): the mean of the normals within a cone about the hint, folded onto its side; the hint itself with fewer than `least`."""
    size = F.sqrt(sum((F.col(c) * F.col(c) for c in n), F.lit(0.0)))
    unit = [F.col(c) / F.greatest(size, F.lit(1e-9)) for c in n]
    along = sum((u * h for u, h in zip(unit, hint, strict=True)), F.lit(0.0))
    inside = F.abs(along) > math.cos(math.radians(degrees))
    means = [F.avg(F.when(inside, F.signum(along) * u)).alias(f"m{i}") for i, u in enumerate(unit)]
    x = normals.groupBy(key).agg(F.count_if(inside).alias("seen"), *means)
    length = F.sqrt(sum((F.col(f"m{i}") * F.col(f"m{i}") for i in range(3)), F.lit(0.0)))
    return x.select(key, F.when(F.col("seen") >= least, F.array(*[F.col(f"m{i}") / length for i in range(3)])).otherwise(F.array(*[F.lit(float(h)) for h in hint])).alias("up"))


def incidence_weight(rays: DataFrame, key: str, cosine: Column, least: float = 0.26) -> DataFrame:
    """(key, weight): the mean |cosine| between rays and a surface's normal; 0 for grazing views."""
    mean = F.avg(F.abs(cosine))
    return rays.groupBy(key).agg(F.when(mean < least, 0.0).otherwise(mean).alias("weight"))


def height_statistics(samples: DataFrame, key: str, height: str) -> DataFrame:
    """(key, low, mean, high, std): of the sampled heights, the deviation that of a population."""
    h = F.col(height)
    return samples.where(h.isNotNull()).groupBy(key).agg(F.min(h).alias("low"), F.avg(h).alias("mean"), F.max(h).alias("high"), F.stddev_pop(h).alias("std"))


def noisy_or(df: DataFrame, key: str, value: Column, confidence: Column) -> DataFrame:
    """(key, n, value, confidence): mean weighted by confidence, at least 0.05, and one minus all doubts."""
    w = F.greatest(confidence, F.lit(0.05))
    doubt = F.sum(F.when(confidence < 1, F.log1p(-confidence)))
    return df.groupBy(key).agg(F.count("*").alias("n"), (F.sum(w * value) / F.sum(w)).alias("value"), F.when(F.max(confidence) >= 1, 1.0).otherwise(1 - F.exp(doubt)).alias("confidence"))


def robust_location(df: DataFrame, key: str, value: str, band: float, rounds: int = 3) -> DataFrame:
    """(key, location, n, rms): a median refined on what lies near it, then the rms of all values in the band.

    Each round measures all values from the centre so far and takes the median of those within three
    scaled median deviations, at least 0.01 and at most the band; where none lie so near the centre
    stays.  A round's centres are a row per key in the checkpoint folder, so a plan reads its input
    once for each median.  A null key is no key.
    """
    x = df.select(key, F.col(value).alias("v")).where(F.col(key).isNotNull() & F.col("v").isNotNull())
    centre = checkpointed(x.groupBy(key).agg(F.median("v").alias("c")))
    away = F.abs(F.col("v") - F.col("c"))
    for _ in range(rounds):
        mad = checkpointed(_by_key(x, centre, key).groupBy(key, "c").agg(F.median(away).alias("mad")))
        cutoff = F.least(F.lit(band), F.greatest(F.lit(0.01), 3.0 * 1.4826 * F.col("mad")))
        kept = _by_key(x, mad, key).groupBy(key, "c").agg(F.median(F.when(away <= cutoff, F.col("v"))).alias("next"))
        centre = checkpointed(kept.select(key, F.coalesce("next", "c").alias("c")))
    near = _by_key(x, centre, key).where(away <= band)
    return near.groupBy(key, F.col("c").alias("location")).agg(F.count("*").alias("n"), F.sqrt(F.avg(F.pow(F.col("v") - F.col("c"), 2))).alias("rms"))


def _by_key(x: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """x with a table of one row per key, broadcast if they are few."""
    return x.join(small(table), key)


def conformal_scale(df: DataFrame, error: Column, width: Column, coverage: float) -> DataFrame:
    """One row: the factor on half-widths that covers `coverage` of the errors, and coverage before and after."""
    x = df.select(F.abs(error).alias("e"), width.alias("w")).where("w > 0")
    scale = x.agg(F.percentile(F.col("e") / F.col("w"), coverage).alias("scale"))
    y = x.crossJoin(F.broadcast(scale))
    return y.agg(F.first("scale").alias("scale"), F.avg((F.col("e") <= F.col("w")).cast("double")).alias("before"), F.avg((F.col("e") <= F.col("w") * F.col("scale")).cast("double")).alias("after"))


def circular_frame(df: DataFrame, key: str, x: Column, y: Column) -> DataFrame:
    """(key, yaw, manhattan): the direction of four-fold symmetry and how strong it is."""
    a = 4 * F.atan2(y, x)
    m = df.groupBy(key).agg(F.avg(F.cos(a)).alias("c"), F.avg(F.sin(a)).alias("s"))
    return m.select(key, (F.atan2("s", "c") / 4).alias("yaw"), F.hypot("c", "s").alias("manhattan"))


def quantile_trend(df: DataFrame, x: str, y: str, bins: int, least: int) -> DataFrame:
    """(bin, x, y, n): medians of y in half-open quantile bins of x."""
    z = df.select(F.col(x).alias("x"), F.col(y).alias("y"))
    # with no x at all the edge is null, as an aggregate without rows has it
    edges = quantiles(z, [], "x", [i / bins for i in range(bins + 1)]).select(F.array_distinct("q").alias("e"))
    edges = z.sparkSession.range(1).join(edges, how="left").select("e")  # one row
    bin_ = reduce(add, [F.when(F.get("e", F.lit(i)) <= F.col("x"), 1).otherwise(0) for i in range(bins + 1)])
    dealt = lambda df: df.crossJoin(F.broadcast(edges)).withColumn("bin", bin_).where("bin < size(e)").drop("e")
    counts = written(dealt(z.groupBy("x").agg(F.count("*").alias("n"))))
    n = counts.groupBy("bin").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    for df, c, weight in ((dealt(z), "y", None), (counts, "x", "n")):
        n = n.join(quantiles(df, ["bin"], c, [0.5], weight).select("bin", F.col("q")[0].alias(c)), "bin", "left")
    return n.select("bin", "x", "y", "n")
