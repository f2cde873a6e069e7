"""Queries of views, heights, grids of plans and surfaces, and robust scales, from the embeddings, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evidence, fits, grids, scoring
from ..sources.tables import table
from .rooms import _BOXES, _boxes
from .series import r6

_e = lambda i: F.col("embedding")[i].cast("double")


def view_weights(s, d):
    """How squarely each label's rays meet the surface that the next numbers are the normal of."""
    size = lambda a: F.sqrt(sum((_e(i) * _e(i) for i in range(a, a + 3)), F.lit(0.0)))
    cosine = sum((_e(i) * _e(i + 3) for i in range(3)), F.lit(0.0)) / (size(0) * size(3))
    x = table(s, d, "embeddings").select(F.expr("vec_id div 5").alias("view"), cosine.alias("c"))
    return evidence.incidence_weight(x, "view", F.col("c"), 0.4).select("view", *r6("weight"))


def upward_normals(s, d):
    """The direction up of each label, from normals within a wide cone about z."""
    x = table(s, d, "embeddings").select("label", *[_e(i).alias(n) for i, n in enumerate(("a", "b", "c"))])
    up = evidence.refined_up(x, "label", ["a", "b", "c"], [0.0, 0.0, 1.0], 60.0, 20)
    return up.select("label", *[F.round(F.col("up")[i], 6).alias(f"up{i}") for i in range(3)])


def height_samples(s, d):
    """Heights sampled for each room: least, mean, greatest and their deviation."""
    x = table(s, d, "embeddings").select(F.expr("vec_id div 8").alias("room"), F.when(F.abs(_e(1)) < 0.3, 2.4 + _e(0)).alias("h"))
    return evidence.height_statistics(x, "room", "h").select("room", *r6("low", "mean", "high", "std"))


def plan_cells(s, d):
    """Cells of a plan with points in the wall band and on the floor, and those that the camera passed."""
    x = table(s, d, "embeddings").select((_e(0) * 10).alias("u"), (_e(1) * 10).alias("v"), (_e(2) * 4 + 0.5).alias("h"))
    path = table(s, d, "embeddings").select((_e(3) * 8).alias("u"), (_e(4) * 8).alias("v"))
    out = grids.plan_grid(x, 0.0, 2.2, path, resolution=0.5)
    return out.select("cu", "cv", "occupied", "free", *r6("u0", "v0"))


def surface_spans(s, d):
    """Spans of surfaces that something stood before."""
    x = table(s, d, "embeddings").select("label", F.floor((_e(0) + 0.5) * 20).alias("cu"), F.floor((_e(1) + 0.5) * 6).alias("cv"), F.pmod("vec_id", F.lit(3)).alias("hits"), F.pmod("vec_id", F.lit(5)).alias("near"))
    cells = x.groupBy("label", "cu", "cv").agg(F.sum(F.when(F.col("hits") > 1, 1).otherwise(0)).alias("hits"), F.sum("near").alias("near"))
    out = grids.hidden_spans(cells, "label", F.lit(20), F.lit(6), 0.25, 2, 0.2, 0.5)
    return out.select("label", *r6("low", "high"))


def depth_scales(s, d):
    """Repeated-median scale and shift between two depths of each label's pixels."""
    x = table(s, d, "embeddings").select("label", (_e(0) + 2).alias("a"), ((_e(0) + 2) * 1.5 + 0.3 + F.when(F.pmod("vec_id", F.lit(6)) == 0, _e(1) * 8).otherwise(_e(1) * 0.01)).alias("b"))
    return fits.scale_shift(x, "label", "a", "b", least=20).select("label", "n", *r6("scale", "shift", "rms"))


def footprints(s, d):
    """The area of all rooms against a known one; rooms without an area are counted."""
    x = _boxes(s, d).select(F.when(F.pmod("id", F.lit(9)) > 0, (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))).alias("area"))
    return scoring.footprint_error(x, 12_000.0)


_V = "embedding[{}]::DOUBLE".format
ORACLES = {
    "view_weights": f"WITH x AS (SELECT vec_id // 5 AS view, avg(abs(({_V(1)} * {_V(4)} + {_V(2)} * {_V(5)} + {_V(3)} * {_V(6)}) / (sqrt({_V(1)}**2 + {_V(2)}**2 + {_V(3)}**2) * sqrt({_V(4)}**2 + {_V(5)}**2 + {_V(6)}**2)))) AS m FROM embeddings GROUP BY 1) SELECT view, round(CASE WHEN m < 0.4 THEN 0 ELSE m END, 6)::DOUBLE AS weight FROM x",
    "upward_normals": f"""WITH x AS (SELECT label, {_V(1)} AS a, {_V(2)} AS b, {_V(3)} AS c, greatest(sqrt({_V(1)}**2 + {_V(2)}**2 + {_V(3)}**2), 1e-9) AS s FROM embeddings),
m AS (SELECT label, count(*) FILTER (abs(c / s) > cos(radians(60))) AS n, avg(sign(c) * a / s) FILTER (abs(c / s) > cos(radians(60))) AS a, avg(sign(c) * b / s) FILTER (abs(c / s) > cos(radians(60))) AS b, avg(sign(c) * c / s) FILTER (abs(c / s) > cos(radians(60))) AS c FROM x GROUP BY label)
SELECT label, round(CASE WHEN n >= 20 THEN a / sqrt(a*a + b*b + c*c) ELSE 0 END, 6) AS up0, round(CASE WHEN n >= 20 THEN b / sqrt(a*a + b*b + c*c) ELSE 0 END, 6) AS up1, round(CASE WHEN n >= 20 THEN c / sqrt(a*a + b*b + c*c) ELSE 1 END, 6) AS up2 FROM m""",
    "height_samples": f"WITH x AS (SELECT vec_id // 8 AS room, 2.4::DOUBLE + {_V(1)} AS h FROM embeddings WHERE abs({_V(2)}) < 0.3) SELECT room, round(min(h), 6) AS low, round(avg(h), 6) AS mean, round(max(h), 6) AS high, round(stddev_pop(h), 6) AS std FROM x GROUP BY room",
    "plan_cells": f"""WITH p AS (SELECT {_V(1)} * 10 AS u, {_V(2)} * 10 AS v, {_V(3)} * 4 + 0.5::DOUBLE AS h, {_V(4)} * 8 AS a, {_V(5)} * 8 AS b FROM embeddings),
x AS (SELECT min(u) - 0.5::DOUBLE AS u0, min(v) - 0.5::DOUBLE AS v0, ceil((max(u) + 0.5::DOUBLE - (min(u) - 0.5::DOUBLE)) / 0.5) + 1 AS nu, ceil((max(v) + 0.5::DOUBLE - (min(v) - 0.5::DOUBLE)) / 0.5) + 1 AS nv FROM p),
r AS (SELECT floor((u - u0) / 0.5)::BIGINT AS cu, floor((v - v0) / 0.5)::BIGINT AS cv, (h > 0.35::DOUBLE AND h < 1.9::DOUBLE)::BIGINT AS occupied, (abs(h) < 0.12::DOUBLE)::BIGINT AS free, false AS walked FROM p, x UNION ALL SELECT floor((a - u0) / 0.5)::BIGINT, floor((b - v0) / 0.5)::BIGINT, 0, 0, true FROM p, x),
c AS (SELECT cu, cv, sum(occupied)::BIGINT AS occupied, sum(free)::BIGINT + 3 * bool_or(walked)::BIGINT AS free FROM r, x WHERE cu >= 0 AND cv >= 0 AND cu < nu AND cv < nv GROUP BY cu, cv) SELECT cu, cv, occupied, free, round(u0, 6) AS u0, round(v0, 6) AS v0 FROM c, x WHERE occupied > 0 OR free > 0""",
    "surface_spans": f"""WITH x AS (SELECT label, floor(({_V(1)} + 0.5) * 20)::BIGINT AS cu, floor(({_V(2)} + 0.5) * 6)::BIGINT AS cv, sum((vec_id % 3 > 1)::INT) AS hits, sum(vec_id % 5) AS near FROM embeddings GROUP BY ALL),
h AS (SELECT label, cu, count(*) FILTER (hits = 0 AND near >= 2) AS n FROM x GROUP BY label, cu HAVING count(*) FILTER (hits = 0 AND near >= 2) > 0.2::DOUBLE * 6 AND cu BETWEEN 0 AND 19),
r AS (SELECT label, cu, cu - row_number() OVER (PARTITION BY label ORDER BY cu) AS run FROM h)
SELECT label, round(min(cu) * 0.25::DOUBLE, 6) AS low, round((max(cu) + 1) * 0.25::DOUBLE, 6) AS high FROM r GROUP BY label, run HAVING (max(cu) + 1 - min(cu)) * 0.25 >= 0.5""",
    "depth_scales": f"""WITH x AS (SELECT label, vec_id, {_V(1)} + 2 AS a, ({_V(1)} + 2) * 1.5::DOUBLE + 0.3::DOUBLE + CASE WHEN vec_id % 6 = 0 THEN {_V(2)} * 8 ELSE {_V(2)} * 0.01::DOUBLE END AS b FROM embeddings),
s AS (SELECT p.label, p.vec_id, median((q.b - p.b) / (q.a - p.a)) AS m FROM x p JOIN x q ON p.label = q.label AND p.a <> q.a GROUP BY ALL), k AS (SELECT label, median(m) AS scale FROM s GROUP BY label),
h AS (SELECT x.label, scale, median(b - scale * a) AS shift, count(*) AS n FROM x JOIN k ON k.label = x.label GROUP BY ALL)
SELECT h.label, n, round(scale, 6) AS scale, round(shift, 6) AS shift, round(sqrt(avg((scale * a + shift - b)**2)), 6) AS rms FROM h JOIN x ON x.label = h.label WHERE n >= 20 GROUP BY ALL""",
    "footprints": f"WITH {_BOXES}, a AS (SELECT CASE WHEN id % 9 > 0 THEN (x1 - x0) * (y1 - y0) END AS area FROM b) SELECT round(sum(area), 3) AS predicted_m2, round(abs(sum(area) - 12000) / 12000, 4) AS rel_error, count(*) FILTER (area IS NULL) AS n_unmeasured, abs(sum(area) - 12000) / 12000 <= 0.02 AS passed FROM a",
}

QUERIES = {f.__name__: f for f in (view_weights, upward_normals, height_samples, plan_cells, surface_spans, depth_scales, footprints)}
