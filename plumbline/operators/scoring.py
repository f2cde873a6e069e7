"""Scores of results against truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def gate_report(df: DataFrame, kind: str, error: Column, gate: Column, width: Column) -> DataFrame:
    """Per kind: share within its gate, error quantiles, and share of intervals that cover the truth."""
    e = F.abs(error)
    return df.groupBy(kind).agg(F.count("*").alias("n"), F.avg((e <= gate).cast("double")).alias("passed"), F.median(e).alias("median_error"), F.percentile(e, 0.9).alias("p90_error"), F.max(e).alias("max_error"), F.avg((e <= width).cast("double")).alias("covered"))


def macro_f1(df: DataFrame, truth: str, found: str) -> DataFrame:
    """One row: the mean F1 of the classes that occur, and how many they are."""
    x = df.select(F.explode(F.array(F.struct(F.col(truth).alias("c"), (F.col(truth) == F.col(found)).cast("int").alias("tp"), F.lit(0).alias("fp"), (F.col(truth) != F.col(found)).cast("int").alias("fn")), F.struct(F.col(found).alias("c"), F.lit(0).alias("tp"), (F.col(truth) != F.col(found)).cast("int").alias("fp"), F.lit(0).alias("fn")))).alias("s")).select("s.*")
    per = x.groupBy("c").agg(*[F.sum(k).alias(k) for k in ("tp", "fp", "fn")]).where("tp + fp + fn > 0")
    return per.agg(F.avg(2 * F.col("tp") / (2 * F.col("tp") + F.col("fp") + F.col("fn"))).alias("macro_f1"), F.count("*").alias("n_classes"))


def set_scores(truth: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """One row: precision and recall of distinct keys."""
    t, f = truth.select(*keys).distinct().withColumn("t", F.lit(1)), found.select(*keys).distinct().withColumn("f", F.lit(1))
    x = t.join(f, keys, "full").agg(F.count("t").alias("n_truth"), F.count("f").alias("n_found"), F.count_if(F.col("t") + F.col("f") == 2).alias("n_both"))
    return x.select("n_truth", "n_found", "n_both", F.try_divide("n_both", "n_found").alias("precision"), F.try_divide("n_both", "n_truth").alias("recall"))


def largest(df: DataFrame, key: str, size: str, tie: str) -> DataFrame:
    """The largest row of each key, the first of equals."""
    return df.withColumn("__r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(size), tie))).where("__r = 1").drop("__r")


def box_iou(a: list[Column], b: list[Column]) -> Column:
    """Intersection over union of boxes (u0, u1, v0, v1); 0 if one is missing."""
    side = lambda i: F.greatest(F.lit(0.0), F.least(a[i + 1], b[i + 1]) - F.greatest(a[i], b[i]))
    both = side(0) * side(2)
    area = lambda x: (x[1] - x[0]) * (x[3] - x[2])
    return F.coalesce(F.try_divide(both, area(a) + area(b) - both), F.lit(0.0))


def head_to_head(df: DataFrame, ours: Column, theirs: Column, tie: float) -> DataFrame:
    """One row: wins, ties and losses by absolute error, within `tie` of each other a tie."""
    d = F.abs(ours) - F.abs(theirs)
    return df.agg(F.count_if(d < -tie).alias("wins"), F.count_if(F.abs(d) <= tie).alias("ties"), F.count_if(d > tie).alias("losses"))


# Fixed values: (gate, kind, label, absolute limit, share of the truth, target share of passes); the limit is the larger of both.
GATES = (
    ("wall_length", "wall_length", "Wall length error <= max(1%, 2cm)", 0.02, 0.01, 0.90),
    ("wall_length_stretch", "wall_length", "Wall length error <= 0.5%  [stretch]", 0.0, 0.005, 0.90),
    ("ceiling_height", "ceiling_height", "Ceiling height error <= 1.5cm", 0.015, 0.0, 1.00),
    ("floor_area", "floor_area", "Floor area error <= 2%", 0.0, 0.02, 1.00),
    ("opening_width", "opening_width", "Door/window width error <= 2cm", 0.02, 0.0, 0.85),
    ("damage_area", "damage_area", "Affected-area quantity within +/-10%", 0.0, 0.10, 1.00),
)


def gate_table(comparisons: DataFrame, gates: tuple[tuple, ...] = GATES) -> DataFrame:
    """(gate, label, passing, total, fraction, target, passed) of each gate that comparisons(kind, truth, predicted) meet."""
    table = comparisons.sparkSession.createDataFrame([tuple(g) for g in gates], "gate string, kind string, label string, flat double, share double, target double")
    x = comparisons.join(F.broadcast(table), "kind")  # a row per gate
    limit = F.greatest(F.col("flat"), F.col("share") * F.when(F.col("flat") > 0, F.col("truth")).otherwise(F.greatest(F.abs("truth"), F.lit(1e-6))))
    ok = F.count_if(F.abs(F.col("predicted") - F.col("truth")) <= limit)
    out = x.groupBy("gate", "label", "target").agg(ok.alias("passing"), F.count("*").alias("total")).withColumn("fraction", F.round(F.col("passing") / F.col("total"), 4))
    return out.select("gate", "label", "passing", "total", "fraction", "target", (F.col("passing") / F.col("total") >= F.col("target")).alias("passed"))


def interval_report(comparisons: DataFrame, coverage: float = 0.9) -> DataFrame:
    """(kind, n, median, p90 and largest error in mm, observed coverage, calibrated) of comparisons(kind, truth, predicted, half_width)."""
    e = F.abs(F.col("predicted") - F.col("truth"))
    mm = lambda c: F.round(c * 1000, 2)
    inside = F.avg((e <= F.col("half_width")).cast("double"))
    return comparisons.groupBy("kind").agg(F.count("*").alias("n"), mm(F.median(e)).alias("median_error_mm"), mm(F.percentile(e, 0.9)).alias("p90_error_mm"), mm(F.max(e)).alias("max_error_mm"), F.round(inside, 4).alias("observed"), (F.abs(inside - coverage) <= 0.1).alias("calibrated"))


def water_scores(regions: DataFrame, reference: DataFrame) -> DataFrame:
    """One row (correct, checked, fraction, passed): category and class of each surface's largest water region against the reference.

    regions(surface, damage_class, area, id, water_category, water_class), reference(surface, water_category,
    water_class) as texts; a blank field is not asked for, a row without any is not checked.
    """
    best = largest(regions.where("damage_class in ('water', 'combined')"), "surface", "area", "id")
    found = best.select("surface", *[F.col(c).cast("string").alias(f"f_{c}") for c in ("water_category", "water_class")])
    x = reference.join(found, "surface", "left")
    asked = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    ok = lambda c: ~asked(c) | F.coalesce(F.col(c) == F.col(f"f_{c}"), F.lit(False))
    both = ("water_category", "water_class")
    x = x.where(asked(both[0]) | asked(both[1])).agg(F.count_if(ok(both[0]) & ok(both[1])).alias("correct"), F.count("*").alias("checked"))
    share = F.coalesce(F.try_divide("correct", "checked"), F.lit(0.0))
    return x.select("correct", "checked", F.round(share, 4).alias("fraction"), (share >= 0.7).alias("passed"))


def footprint_error(rooms: DataFrame, reference: float) -> DataFrame:
    """One row (predicted_m2, rel_error, n_unmeasured, passed): the rooms' area against a known one; unmeasured rooms are counted, not added."""
    total = F.coalesce(F.sum("area"), F.lit(0.0))
    error = F.abs(total - reference) / max(reference, 1e-6)
    return rooms.agg(F.round(total, 3).alias("predicted_m2"), F.round(error, 4).alias("rel_error"), F.count_if(F.col("area").isNull()).alias("n_unmeasured"), (error <= 0.02).alias("passed"))


def last_by(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each key by order: what an index holds where a key repeats."""
    w = Window.partitionBy(*keys).orderBy(F.desc(order))
    return df.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")
