"""What moves walls: residuals of tagged observations by cause, and a sweep over depth gates.

Lengths are counted in whole steps of a stated resolution before any quantile is taken, so that
an exact median holds a bounded number of distinct values, however many observations there are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Resolution of residuals, ranges and |cosines|, and the side of the squares that points and walls meet in.
STEP, RANGE_STEP, COSINE_STEP, CELL = 1e-5, 1e-3, 1e-4, 0.5


def steps(x, step: float):
    """x in whole steps, the nearest one."""
    return F.floor(x / step + 0.5).cast("long")


def beside_walls(points: DataFrame, walls: DataFrame, band: float, min_length: float = 1.5, margin: float = 0.0, cell: float = CELL) -> DataFrame:
    """points(capture, x, y, ...) with the wall each is beside, `signed` (steps of STEP off its line) and wall_length.

    walls(capture, wall, nx, ny, offset, sx, sy, dx, dy, length), lengths in metres; those shorter than
    min_length are left out, and `margin` of either end.  A point beside several walls comes once for each.
    Points and walls meet in squares of side `cell`, which must be at least twice the band.
    """
    if band * 2 > cell:
        raise ValueError("the squares must be at least twice as wide as the band")
    along = F.explode(F.sequence(F.lit(0), F.ceil(F.col("length") / cell).cast("int"))).alias("k")
    w = walls.where(F.col("length") >= min_length).withColumnRenamed("length", "wall_length")
    w = w.withColumn("length", F.col("wall_length")).select("*", along)
    side = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    at = lambda s, d: F.floor((F.col(s) + F.col(d) * F.col("k") * cell) / cell)
    w = w.withColumn("cx", at("sx", "dx")).withColumn("cy", at("sy", "dy")).withColumn("i", F.explode(side)).withColumn("j", F.explode(side))
    w = w.withColumn("cx", F.col("cx") + F.col("i")).withColumn("cy", F.col("cy") + F.col("j"))
    w = w.drop("k", "i", "j", "length").dropDuplicates(["capture", "wall", "cx", "cy"])
    p = points.withColumn("cx", F.floor(F.col("x") / cell)).withColumn("cy", F.floor(F.col("y") / cell))
    off = F.col("nx") * F.col("x") + F.col("ny") * F.col("y") - F.col("offset")
    run = (F.col("x") - F.col("sx")) * F.col("dx") + (F.col("y") - F.col("sy")) * F.col("dy")
    near = p.join(w, ["capture", "cx", "cy"]).where((F.abs(off) < band) & (run > margin) & (run < F.col("wall_length") - margin))
    return near.withColumn("signed", steps(off, STEP)).drop("cx", "cy")


def residuals(near: DataFrame, least: int) -> DataFrame:
    """(residual, range, incidence, confidence) of observations beside walls with `least` or more of them.

    near is of beside_walls with the plan part (rx, ry) of unit rays.  A residual is the distance to the
    wall's median, in metres, positive on the far side as the ray sees it.
    """
    mid = near.groupBy("capture", "wall").agg(F.median("signed").alias("mid"), F.count("*").alias("seen")).where(F.col("seen") >= least)
    facing = F.col("rx") * F.col("nx") + F.col("ry") * F.col("ny")
    r = (F.col("signed") - F.col("mid")) * F.signum(facing)
    return near.join(mid, ["capture", "wall"]).select((r * STEP).alias("residual"), "range", F.abs(facing).alias("incidence"), "confidence")


def binned(pooled: DataFrame, factor: str, bins: int, step: float, least: int) -> DataFrame:
    """(factor, bin, centre, median, iqr, n) of residuals in half-open bins between quantiles of a factor."""
    x = pooled.select(steps(F.col(factor), step).alias("x"), "residual")
    edges = x.agg(F.array_distinct(F.percentile("x", F.array(*[F.lit(i / bins) for i in range(bins + 1)]))).alias("e"))
    x = x.crossJoin(F.broadcast(edges))  # one row
    x = x.withColumn("bin", F.size(F.filter("e", lambda v: v <= F.col("x")))).where("bin < size(e)")
    centre = (F.col("e")[F.col("bin") - 1] + F.col("e")[F.col("bin")]) / 2 * step
    return _spread(x.select(F.lit(factor).alias("factor"), F.col("bin").cast("long").alias("bin"), centre.alias("centre"), "residual"), least)


def _spread(x: DataFrame, least: int) -> DataFrame:
    q = F.percentile("residual", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    out = x.groupBy("factor", "bin", "centre").agg(q.alias("q"), F.count("*").alias("n")).where(F.col("n") >= least)
    return out.select("factor", "bin", "centre", F.col("q")[1].alias("median"), (F.col("q")[2] - F.col("q")[0]).alias("iqr"), "n")


def attribution(pooled: DataFrame, least: int = 200) -> DataFrame:
    """Residuals by range (10 bins), by incidence (8 bins; 1 is face-on) and by level of confidence."""
    level = pooled.where("confidence in (0, 1, 2)").select(F.lit("confidence").alias("factor"), F.col("confidence").cast("long").alias("bin"), F.col("confidence").cast("double").alias("centre"), "residual")
    return binned(pooled, "range", 10, RANGE_STEP, least).unionByName(binned(pooled, "incidence", 8, COSINE_STEP, least)).unionByName(_spread(level, least))


def slope(trend: DataFrame) -> DataFrame:
    """(slope_mm_per_m, offset_mm, span_mm) of the medians by range; no row for fewer than three bins."""
    y, x = F.col("median"), F.col("centre")
    out = trend.where("factor = 'range'").agg(F.count("*").alias("k"), F.regr_slope(y, x).alias("a"), F.regr_intercept(y, x).alias("b"), (F.max(x) - F.min(x)).alias("w"))
    return out.where("k > 2").select((F.col("a") * 1000).alias("slope_mm_per_m"), (F.col("b") * 1000).alias("offset_mm"), (F.abs("a") * F.col("w") * 1000).alias("span_mm"))


def gating_sweep(points: DataFrame, walls: DataFrame, gates: list[tuple[int, float]], gap: float, least: int, band: float = 0.04, margin: float = 0.15, tie: str = "id") -> DataFrame:
    """One row for each gate (least confidence, greatest range): what it keeps and how far walls drift, against the first.

    (gate, min_confidence, max_range, points, walls, wall_m, revisited, drift_median_mm, drift_p90_mm, drift_change,
    coverage_change).  A wall counts with `least` or more points and drifts by the range of its visits' medians,
    a visit being a run of its kept points without a longer gap; the given walls serve every gate.  All gates
    share one sort of a wall's points; what differs between them is counted before rows are dealt out by gate.
    """
    keeps = [(F.col("confidence") >= c) & (F.col("range") <= r) for c, r in gates]
    total = points.agg(*[F.count_if(k).alias(f"n{i}") for i, k in enumerate(keeps)])
    total = total.select(F.posexplode(F.array(*[f"n{i}" for i in range(len(gates))])).alias("gate", "points"))
    near = beside_walls(points, walls, band, margin=margin).where(reduce(lambda a, b: a | b, keeps))
    order = Window.partitionBy("capture", "wall").orderBy("t", tie)
    past, upto = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, 0)
    for i, k in enumerate(keeps):
        near = near.withColumn(f"jump{i}", F.when(k & (F.col("t") - F.last(F.when(k, F.col("t")), True).over(past) > gap), 1).otherwise(0))
    visit = F.array(*[F.when(k, F.sum(f"jump{i}").over(upto)) for i, k in enumerate(keeps)])  # null: the gate drops the point
    same = near.withColumn("visits", visit).groupBy("capture", "wall", "wall_length", "visits", "signed").agg(F.count("*").alias("m"))
    dealt = same.select("capture", "wall", "wall_length", "signed", "m", F.posexplode("visits").alias("gate", "visit")).where("visit is not null")
    each = dealt.groupBy("gate", "capture", "wall", "wall_length", "visit").agg(F.percentile("signed", 0.5, F.col("m")).alias("mid"), F.sum("m").alias("m"))
    full = F.col("m") >= least
    wall = each.groupBy("gate", "capture", "wall", "wall_length").agg(F.sum("m").alias("m"), F.count_if(full).alias("v"), (F.max(F.when(full, F.col("mid"))) - F.min(F.when(full, F.col("mid")))).alias("spread"))
    wall = wall.withColumn("spread", F.when(F.col("v") >= 2, F.floor(F.col("spread") * 2))).where(F.col("m") >= least)  # medians are halves
    mm = STEP * 500
    found = wall.groupBy("gate").agg(F.count("*").alias("walls"), F.sum("wall_length").alias("wall_m"), F.count("spread").alias("revisited"), (F.median("spread") * mm).alias("drift_median_mm"), (F.percentile("spread", 0.9) * mm).alias("drift_p90_mm"))
    names = F.array(*[F.struct(F.lit(c).alias("min_confidence"), F.lit(float(r)).alias("max_range")) for c, r in gates])
    out = total.join(F.broadcast(found), "gate", "left").withColumn("g", names[F.col("gate")])  # a row a gate
    out = out.withColumn("walls", F.coalesce("walls", F.lit(0))).withColumn("revisited", F.coalesce("revisited", F.lit(0)))
    first = out.where("gate = 0").select(F.col("drift_median_mm").alias("d0"), F.col("wall_m").alias("w0"))
    out = out.crossJoin(F.broadcast(first))  # one row
    change = lambda a, b: F.when(F.col(b) != 0, 100 * (F.col(a) / F.col(b) - 1))
    return out.select("gate", "g.*", "points", "walls", "wall_m", "revisited", "drift_median_mm", "drift_p90_mm", (-change("drift_median_mm", "d0")).alias("drift_change"), change("wall_m", "w0").alias("coverage_change"))
