"""Planes of points in space and walls of points on a plan, peeled off one after the other for all captures at once.

A round draws hypotheses from a bounded working sample of each capture's points, scores them by one
aggregation, refits the best by total least squares on all points near it, and takes these points
away.  Every step is a join or an aggregation over all captures that still go on, with partial sums
before the shuffle; the driver learns only whether any do.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.frames import nearest_axis, plane_class
from ..functions.geometry import canonical_sign, line_angle, manhattan_deviation
from .graphs import written
from .joins import small

_FINITE = "{c} is not null and not isnan({c}) and abs({c}) < double('infinity')"


def _finite(df: DataFrame, *names: str) -> DataFrame:
    return df.where(" and ".join(_FINITE.format(c=c) for c in names))


def _sample(left: DataFrame, key: str, pool: int, seed: int) -> DataFrame:
    """left with a place 0, 1, ... in the key's working sample of about `pool` points, drawn by a seeded hash of ids, and its size."""
    chance = F.least(F.lit(1.0), F.lit(float(pool)) / F.col("all"))
    h = F.xxhash64(key, "id", F.lit(seed))
    some = left.join(small(left.groupBy(key).agg(F.count("*").alias("all"))), key).where(F.pmod(h, F.lit(1 << 30)) < chance * (1 << 30)).withColumn("h", h)
    line = Window.partitionBy(key)  # a sample, so bounded
    return some.withColumn("place", F.row_number().over(line.orderBy("h", "id")) - 1).withColumn("size", F.count("*").over(line)).drop("h", "all")


def _draws(sample: DataFrame, key: str, tries: int, seed: int, parts: str, coordinates: str) -> DataFrame:
    """(key, try, p0, p1, ...): points of the sample for each try, their places drawn by a seeded hash."""
    each = sample.groupBy(key).agg(F.max("size").alias("size")).withColumn("try", F.explode(F.sequence(F.lit(0), F.lit(tries - 1))))
    for part in parts:
        at = sample.select(key, F.col("place").alias("at"), F.array(*coordinates).alias(f"p{part}"))
        each = each.withColumn("at", F.pmod(F.xxhash64(key, "try", F.lit(seed), F.lit(part)), F.col("size"))).join(at, [key, "at"]).drop("at")
    return each.drop("size")


def _moments(near: DataFrame, key: str, axes: str) -> DataFrame:
    """(key, n, mark, sums): how many points, which ones by a checksum, and their moments."""
    pairs = [(a, b) for i, a in enumerate(axes) for b in axes[i:]]
    mark = F.sum(F.xxhash64("id").cast("decimal(38,0)"))
    return near.groupBy(key).agg(F.count("*").alias("n"), mark.alias("mark"), *[F.avg(c).alias(f"m{c}") for c in axes], *[F.covar_pop(a, b).alias(f"s{a}{b}") for a, b in pairs])


def _tls_plane(m: DataFrame, key: str) -> DataFrame:
    """m with the plane (nx, ny, nz, offset) of its moments and the two lesser spreads."""

    def solve(batches):
        for g in batches:
            c = np.array([[[r[f"s{''.join(sorted(a + b))}"] for b in "xyz"] for a in "xyz"] for r in g.to_dict("records")], float).reshape(-1, 3, 3)
            values, vectors = np.linalg.eigh(c)
            n = _signed(vectors[:, :, 0])
            g["nx"], g["ny"], g["nz"] = n.T
            g["thin"], g["middle"] = values[:, 0].clip(0), values[:, 1].clip(0)
            g["offset"] = (n * g[["mx", "my", "mz"]].to_numpy(float)).sum(axis=1)
            yield g[[key, "n", "mark", "mx", "my", "mz", "nx", "ny", "nz", "thin", "middle", "offset"]]

    kinds = dict(m.dtypes)
    return m.mapInPandas(solve, f"{key} {kinds[key]}, n long, mark {kinds['mark']}, mx double, my double, mz double, nx double, ny double, nz double, thin double, middle double, offset double")


def _signed(n: np.ndarray) -> np.ndarray:
    """Rows of normals, each with its largest component (the first of equal ones) positive."""
    pivot = n[np.arange(len(n)), np.abs(n).argmax(axis=1)] if len(n) else np.zeros(0)
    return np.where(pivot < 0, -1.0, 1.0)[:, None] * n


def _tried_planes(three: DataFrame, key: str) -> DataFrame:
    """(key, try, nx, ny, nz, offset) of the tries whose three points are on no line."""

    def fit(batches):
        for g in batches:
            a, b, c = (np.array(g[f"p{i}"].tolist(), float).reshape(-1, 3) for i in range(3))
            n = np.cross(b - a, c - a)
            size = np.linalg.norm(n, axis=1)
            ok = (size > 1e-8) & np.isfinite(size)
            n = _signed(n[ok] / size[ok, None])
            out = g.loc[ok, [key, "try"]].copy()
            out["nx"], out["ny"], out["nz"], out["offset"] = *n.T, (n * a[ok]).sum(axis=1)
            yield out

    return three.mapInPandas(fit, f"{key} {dict(three.dtypes)[key]}, try int, nx double, ny double, nz double, offset double")


_NORMAL = ("nx", "ny", "nz")


def _away(x: DataFrame) -> Column:
    return F.abs(F.col("x") * F.col("nx") + F.col("y") * F.col("ny") + F.col("z") * F.col("nz") - F.col("offset"))


def peeled_planes(points: DataFrame, key: str, threshold: float = 0.03, least: int = 30, most: int = 80, tries: int = 400, pool: int = 10_000, seed: int = 0, span: float = 1e-3) -> tuple[DataFrame, DataFrame]:
    """(planes, members): planes (key, plane, n, nx, ny, nz, offset) of points(key, id, x, y, z), and which points they hold (key, plane, id).

    A round takes the plane through three sample points with most of the sample within the threshold, of equals
    the tighter one, then refits it to all points near it until these stay the same, five times at most.  A capture ends when
    its best plane has fewer than `least` points or `most` planes are found; points on one line are taken
    away without a plane.  Points that are not finite belong to none.
    """
    left = written(_finite(points.select(key, "id", "x", "y", "z"), "x", "y", "z"))
    planes = members = None
    count = left.groupBy(key).count()
    going = written(count.where(F.col("count") >= max(3, least)).select(key))
    for k in range(most):
        if going.isEmpty():
            break
        sample = written(_sample(left.join(small(going), key, "left_semi"), key, pool, seed + k))
        three = _draws(sample, key, tries, seed + k, "012", "xyz")
        scored = sample.join(_tried_planes(three, key), key).withColumn("d", _away(sample)).where(F.col("d") <= threshold)
        scored = scored.groupBy(key, "try", *_NORMAL, "offset").agg(F.count("*").alias("hits"), F.sqrt(F.avg(F.col("d") * F.col("d"))).alias("rms"))
        rank = F.struct((-F.col("hits")).alias("a"), F.col("rms").alias("b"), *[F.round(c, 12).alias(c) for c in (*_NORMAL, "offset")])
        fit = scored.groupBy(key).agg(F.min_by(F.struct(*_NORMAL, "offset"), rank).alias("h")).select(key, "h.*")
        fit = written(fit.withColumn("mark", F.lit(None).cast("decimal(38,0)")).withColumn("settled", F.lit(False)))
        for _ in range(6):
            near = left.join(small(fit.select(key, *_NORMAL, "offset")), key).where(_away(left) <= threshold)
            new = _tls_plane(_moments(near, key, "xyz"), key)
            old = fit.select(key, F.col("mark").alias("was"), "settled", *[F.col(c).alias(f"o{c}") for c in (*_NORMAL, "offset")])
            new = new.join(old, key).withColumn("same", F.col("settled") | F.coalesce(F.col("mark") == F.col("was"), F.lit(False)))
            # a settled capture keeps the plane that its points were found by
            keep = lambda c: F.when(F.col("same"), F.col(f"o{c}")).otherwise(F.col(c)).alias(c)
            fit = written(new.select(key, *[keep(c) for c in (*_NORMAL, "offset")], "mark", F.col("same").alias("settled"), "n", *[F.col(c).alias(f"f{c}") for c in (*_NORMAL, "offset")], *[F.col(f"o{c}").alias(f"s{c}") for c in (*_NORMAL, "offset")], "middle"))
            if fit.where("not settled").isEmpty():
                break
        good = fit.where(F.col("n") >= max(3, least))
        flat = F.sqrt(F.col("n") * F.col("middle")) <= span
        found = written(good.select(key, F.lit(k).alias("plane"), "n", *[F.col(f"f{c}").alias(c) for c in (*_NORMAL, "offset")], *[f"s{c}" for c in (*_NORMAL, "offset")], flat.alias("flat")))
        by = found.select(key, "plane", "flat", *[F.col(f"s{c}").alias(c) for c in (*_NORMAL, "offset")])
        marked = left.join(small(by), key).withColumn("held", _away(left) <= threshold)  # captures that have ended drop out here
        marked = written(marked.select(key, "id", "x", "y", "z", "plane", "held", "flat"))
        new_planes, new_members = found.where("not flat").select(key, "plane", "n", *_NORMAL, "offset"), marked.where("held and not flat").select(key, "plane", "id")
        planes = new_planes if planes is None else planes.unionByName(new_planes)
        members = new_members if members is None else members.unionByName(new_members)
        left = marked.where("not held").select(key, "id", "x", "y", "z")
        going = written(left.groupBy(key).count().where(F.col("count") >= max(3, least)).select(key))
    if planes is None:
        none = left.where("false")
        planes = none.select(key, F.lit(0).alias("plane"), F.lit(0).cast("long").alias("n"), *[F.lit(0.0).alias(c) for c in (*_NORMAL, "offset")])
        members = none.select(key, F.lit(0).alias("plane"), "id")
    return planes, members


def structural_planes(points: DataFrame, key: str, up: tuple[float, float, float] = (0.0, 0.0, 1.0), degrees: float = 25.0, room_height: float = 1.8, threshold: float = 0.03, least: int = 30, **peel) -> DataFrame:
    """The peeled planes of each capture with their class, evidence and confidence, floors first.

    The floor is the lowest level plane; level planes at least `room_height` above it are ceilings, other level ones and
    slanted ones are clutter and quarantined, upright ones walls.  A floor's normal points up and a
    ceiling's down.  Rows (key, plane, kind, quarantined, n, normal, offset, centroid, bounds, rms, mean, median and
    largest residual, density, extents along the plane, adaptive threshold, confidence).
    """
    planes, members = peeled_planes(points, key, threshold=threshold, least=least, **peel)
    at = members.join(points.select(key, "id", "x", "y", "z"), [key, "id"]).join(small(planes), [key, "plane"])
    d = _away(at)
    axes = ("x", "y", "z")
    pairs = ("xx", "xy", "xz", "yy", "yz", "zz")
    sums = at.withColumn("d", d).groupBy(key, "plane", "n", *_NORMAL, "offset").agg(
        *[F.avg(c).alias(f"c{c}") for c in axes], *[F.min(c).alias(f"lo_{c}") for c in axes], *[F.max(c).alias(f"hi_{c}") for c in axes], *[F.covar_pop(p[0], p[1]).alias(f"s{p}") for p in pairs],
        F.sqrt(F.avg(F.col("d") * F.col("d"))).alias("rms"), F.avg("d").alias("mean_abs"), F.median("d").alias("median_abs"), F.max("d").alias("largest"),
    )

    def tangents(batches):
        for g in batches:
            c = np.array([[[r[f"s{''.join(sorted(a + b))}"] for b in axes] for a in axes] for r in g.to_dict("records")], float).reshape(-1, 3, 3)
            _, v = np.linalg.eigh(c)
            for name, k in (("t", 2), ("b", 1)):
                for i, a in enumerate(axes):
                    g[f"{name}{a}"] = v[:, i, k]
            yield g.drop(columns=[f"s{p}" for p in pairs])

    kinds = dict(sums.dtypes)
    names = [c for c in sums.columns if c not in {f"s{p}" for p in pairs}]
    basis = written(sums.mapInPandas(tangents, ", ".join([f"{c} {kinds[c]}" for c in names] + [f"{n}{a} double" for n in "tb" for a in axes])))
    along = lambda n: sum((F.col(a) - F.col(f"c{a}")) * F.col(f"{n}{a}") for a in axes)
    spread = at.select(key, "plane", *axes, d.alias("d")).join(small(basis.select(key, "plane", *[f"c{a}" for a in axes], *[f"{n}{a}" for n in "tb" for a in axes], "median_abs")), [key, "plane"])
    spread = spread.groupBy(key, "plane").agg((F.max(along("t")) - F.min(along("t"))).alias("length"), (F.max(along("b")) - F.min(along("b"))).alias("width"), F.median(F.abs(F.col("d") - F.col("median_abs"))).alias("mad"))
    x = basis.join(spread, [key, "plane"])
    size = math.sqrt(sum(v * v for v in up)) or 1.0
    u = [v / size for v in up]
    dot = lambda cs: sum((F.col(c) * v for c, v in zip(cs, u, strict=True)), F.lit(0.0))
    x = x.withColumn("height", dot(("cx", "cy", "cz"))).withColumn("aligned", dot(_NORMAL))
    level = F.when(F.abs("aligned") >= math.cos(math.radians(degrees)), F.struct("height", (-F.col("n")).alias("more"), "plane"))
    x = x.withColumn("floor", F.min(level).over(Window.partitionBy(key)))  # a capture has some tens of planes
    lowest = F.coalesce(F.col("floor.height"), F.min("height").over(Window.partitionBy(key)))
    kind = plane_class(F.col("aligned"), F.col("height"), lowest, F.coalesce(F.col("plane") == F.col("floor.plane"), F.lit(False)), degrees, room_height)
    x = x.withColumn("kind", kind["name"]).withColumn("quarantined", kind["quarantined"])
    sign = F.when(((F.col("kind") == "floor") & (F.col("aligned") < 0)) | ((F.col("kind") == "ceiling") & (F.col("aligned") > 0)), -1.0).otherwise(1.0)
    area = F.col("length") * F.col("width")
    density = F.when(area > 1e-9, F.col("n") / area).otherwise(0.0)
    adaptive = F.least(F.greatest(F.lit(threshold), 2.5 * F.greatest(F.lit(0.005), 1.4826 * F.col("mad")) + 0.01), F.lit(max(3 * threshold, 0.12)))
    score = 0.40 * (1 - F.exp(-F.col("n") / float(max(3, least)))) + 0.30 * F.exp(-F.col("rms") / threshold) + 0.15 * density / (density + 25) + 0.15 * F.least(F.lit(1.0), F.col("width") / 0.5)
    order = F.create_map(*[F.lit(v) for kv in (("floor", 0), ("ceiling", 1), ("wall", 2), ("clutter", 3)) for v in kv])
    place = F.row_number().over(Window.partitionBy(key).orderBy(order[F.col("kind")], "height", F.desc("n"), "cx", "cy", "cz")) - 1
    return x.select(
        key, place.alias("plane"), "kind", "quarantined", "n", *[(sign * F.col(c)).alias(c) for c in (*_NORMAL, "offset")], "cx", "cy", "cz", *[f"{e}_{a}" for e in ("lo", "hi") for a in axes],
        "rms", "mean_abs", "median_abs", "largest", density.alias("density"), "length", "width", adaptive.alias("adaptive"), F.least(F.lit(1.0), F.greatest(F.lit(0.0), score)).alias("confidence"),
    )


def fitted_walls(points: DataFrame, key: str, threshold: float = 0.03, least: int = 400, length: float = 0.4, most: int = 80, degrees: float = 8.0, spacing: float = 0.02, coverage: float = 0.06, gap: float = 0.35, tries: int = 300, pool: int = 10_000, apart: float = 0.3, seed: int = 0) -> DataFrame:
    """(key, wall, nx, ny, offset, x0, y0, x1, y1, n, rms, low, high, quarantined): walls of plan points(key, id, x, y, h), h their height, longest first.

    A round takes the line through two sample points at least `apart` that has most of the sample nearer than the
    threshold, refits it to all points near it and, if it is within `degrees` of an axis, turns it onto that axis
    with the median of its points as offset; else its walls are quarantined.  The points along it are split
    where a gap is longer than `gap`, and a run is a wall if it is long enough and its points cover enough of its
    length and the band of heights at the given spacing.  The points near the line then go, whatever became of its
    runs.  A capture ends when its best line has fewer than `least` points, or `most` rounds or walls are reached.
    """
    left = written(_finite(points.select(key, "id", "x", "y", "h"), "x", "y", "h"))
    band = written(left.groupBy(key).agg((F.max("h") - F.min("h")).alias("band")))
    going = written(left.groupBy(key).count().where(F.col("count") >= max(2, least)).select(key))
    found = None
    for k in range(most):
        if going.isEmpty():
            break
        sample = written(_sample(left.join(small(going), key, "left_semi"), key, pool, seed + k))
        dx, dy = (F.col("p1")[i] - F.col("p0")[i] for i in (0, 1))
        size = F.hypot(dx, dy)
        lines = _draws(sample, key, tries, seed + k, "01", "xy").where(size >= apart)
        lines = lines.select(key, "try", F.try_divide(-dy, size).alias("nx"), F.try_divide(dx, size).alias("ny"), F.try_divide(F.col("p0")[1] * dx - F.col("p0")[0] * dy, size).alias("offset"))
        off = F.abs(F.col("x") * F.col("nx") + F.col("y") * F.col("ny") - F.col("offset"))
        scored = sample.join(lines, key).where(off < threshold).groupBy(key, "try", "nx", "ny", "offset").count()
        best = written(scored.groupBy(key).agg(F.max_by(F.struct("nx", "ny", "offset"), F.struct("count", -F.col("try"))).alias("h")).select(key, "h.*"))
        marked = written(left.join(small(best), key).withColumn("held", off < threshold).select(key, "id", "x", "y", "h", "held"))
        on = marked.where("held")
        m = _moments(on, key, "xy").where(F.col("n") >= max(2, least))
        angle = line_angle(F.col("sxx"), F.col("syy"), F.col("sxy"))
        m = m.withColumn("nx", -F.sin(angle)).withColumn("ny", F.cos(angle))
        sign = canonical_sign(F.col("nx"), F.col("ny"))
        m = m.withColumn("ux", sign * F.col("nx")).withColumn("uy", sign * F.col("ny"))
        slanted = manhattan_deviation(F.col("ux"), F.col("uy")) > degrees
        axis = nearest_axis(F.col("ux"), F.col("uy"))
        m = m.select(key, "n", slanted.alias("slanted"), *[F.when(slanted, F.col(c)).otherwise(a).alias(c2) for c, a, c2 in zip(("ux", "uy"), axis, ("nx", "ny"), strict=True)], (F.col("ux") * F.col("mx") + F.col("uy") * F.col("my")).alias("fitted"))
        fit = written(on.join(small(m), key).groupBy(key, "slanted", "nx", "ny").agg(F.first("fitted").alias("fitted"), F.median(F.col("x") * F.col("nx") + F.col("y") * F.col("ny")).alias("middle"), F.min("h").alias("low"), F.max("h").alias("high")).withColumn("offset", F.when(F.col("slanted"), F.col("fitted")).otherwise(F.col("middle"))).drop("fitted", "middle"))
        along = on.join(small(fit), key).withColumn("s", F.col("y") * F.col("nx") - F.col("x") * F.col("ny")).withColumn("d", F.col("x") * F.col("nx") + F.col("y") * F.col("ny") - F.col("offset"))
        # points of one centimetre are one row before the gaps are looked for, so that a long line's points do not meet in a task
        cells = along.groupBy(key, "slanted", "nx", "ny", "offset", "low", "high", F.floor(F.col("s") * 100).alias("c")).agg(F.min("s").alias("lo"), F.max("s").alias("hi"), F.count("*").alias("n"), F.sum(F.col("d") * F.col("d")).alias("d2"))
        line = Window.partitionBy(key).orderBy("c")
        cells = cells.withColumn("new", F.coalesce(F.col("lo") - F.lag("hi").over(line) > gap, F.lit(True)).cast("int")).withColumn("run", F.sum("new").over(line)).withColumn("rms", F.sqrt(F.sum("d2").over(Window.partitionBy(key)) / F.sum("n").over(Window.partitionBy(key))))
        runs = cells.groupBy(key, "run", "slanted", "nx", "ny", "offset", "low", "high", "rms").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n")).join(small(band), key)
        run = F.col("hi") - F.col("lo")
        runs = written(runs.where((run >= length) & (F.col("n") >= coverage * (run / spacing) * (F.col("band") / spacing))).drop("band").withColumn("round", F.lit(k)))
        found = runs if found is None else found.unionByName(runs)
        left = marked.where("not held").join(small(m.select(key)), key, "left_semi").drop("held")
        reached = found.groupBy(key).count().where(F.col("count") >= most).select(key)
        going = written(left.groupBy(key).count().where(F.col("count") >= max(2, least)).select(key).join(reached, key, "left_anti"))
    if found is None:
        zero = [F.lit(0.0).alias(c) for c in ("nx", "ny", "offset", "x0", "y0", "x1", "y1")]
        return left.where("false").select(key, F.lit(0).alias("wall"), *zero, F.lit(0).cast("long").alias("n"), *[F.lit(0.0).alias(c) for c in ("rms", "low", "high")], F.lit(False).alias("quarantined"))
    ends = [(F.col("nx") * F.col("offset") - F.col("ny") * F.col(e)).alias(f"x{i}") for i, e in enumerate(("lo", "hi"))], [(F.col("ny") * F.col("offset") + F.col("nx") * F.col(e)).alias(f"y{i}") for i, e in enumerate(("lo", "hi"))]
    x = found.select(key, "nx", "ny", "offset", ends[0][0], ends[1][0], ends[0][1], ends[1][1], "n", "rms", "low", "high", F.col("slanted").alias("quarantined"), (F.col("hi") - F.col("lo")).alias("length"))
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(F.round("length", 8)), F.desc("n"), *[F.round(c, 8) for c in ("nx", "ny", "offset", "x0", "y0", "x1", "y1")])) - 1
    return x.withColumn("wall", place).where(F.col("wall") < most).select(key, "wall", *[c for c in x.columns if c not in (key, "length")])
