"""Queries that peel planes and walls off points laid out by the embeddings, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import peeling
from ..sources.tables import table
from .series import r6

_e = lambda i: F.col("embedding")[i].cast("double")


def _surface_points(s, d):
    """(capture, id, x, y, z): the points of each label on a floor, a shelf, a ceiling or a wall, some millimetres off, apart from each other."""
    k = F.pmod(F.expr("vec_id div 10"), F.lit(4))
    u, v, off = _e(0) * 20, _e(1) * 20, _e(2) * 0.005
    pick = lambda *cs: F.element_at(F.array(*cs), (k + 1).cast("int"))
    return table(s, d, "embeddings").select(F.col("label").alias("capture"), F.col("vec_id").alias("id"), pick(u, u, u, 9 + off).alias("x"), v.alias("y"), pick(off, 1 + off, 2.5 + off, 1.75 + _e(3)).alias("z"))


def structural_planes(s, d):
    """The planes of each label's points: two level ones in the middle of the room are a ceiling and clutter."""
    x = peeling.structural_planes(_surface_points(s, d), "capture", threshold=0.01, least=5, most=6, tries=100)
    return x.select("capture", "kind", "quarantined", "n", *r6("cx", "cy", "cz", "lo_x", "hi_x", "lo_z", "hi_z"))


def fitted_walls(s, d):
    """The walls of each label's points on a plan: two on axes, one of them broken by a gap."""
    k = F.pmod(F.expr("vec_id div 10"), F.lit(2))
    along = _e(0) * 4 + F.when(_e(0) > 0, 0.5).otherwise(-0.5)
    off = _e(1) * 0.02
    p = table(s, d, "embeddings").select(F.col("label").alias("capture"), F.col("vec_id").alias("id"), F.when(k == 0, along).otherwise(4 + off).alias("x"), F.when(k == 0, 2 + off).otherwise(_e(0) * 4 - 4).alias("y"), _e(2).alias("h"))
    x = peeling.fitted_walls(p, "capture", least=5, coverage=0.0, gap=0.9, tries=100, most=6)
    return x.select("capture", *r6("nx", "ny", "offset", "x0", "y0", "x1", "y1"), "n", *r6("low", "high"), "quarantined")


ORACLES = {
    "structural_planes": """WITH e AS (SELECT label AS capture, vec_id // 10 % 4 AS k, embedding[1]::DOUBLE * 20 AS u, embedding[2]::DOUBLE * 20 AS y, embedding[3]::DOUBLE * 0.005 AS w, embedding[4]::DOUBLE AS v FROM embeddings),
p AS (SELECT capture, k, CASE WHEN k < 3 THEN u ELSE 9 + w END AS x, y, CASE k WHEN 0 THEN w WHEN 1 THEN 1 + w WHEN 2 THEN 2.5 + w ELSE 1.75 + v END AS z FROM e)
SELECT capture, CASE k WHEN 0 THEN 'floor' WHEN 1 THEN 'clutter' WHEN 2 THEN 'ceiling' ELSE 'wall' END AS kind, k = 1 AS quarantined, count(*) AS n, round(avg(x), 6) AS cx, round(avg(y), 6) AS cy, round(avg(z), 6) AS cz, round(min(x), 6) AS lo_x, round(max(x), 6) AS hi_x, round(min(z), 6) AS lo_z, round(max(z), 6) AS hi_z FROM p GROUP BY capture, k""",
    "fitted_walls": """WITH e AS (SELECT label AS capture, vec_id // 10 % 2 AS k, embedding[1]::DOUBLE AS e0, embedding[2]::DOUBLE * 0.02 AS w, embedding[3]::DOUBLE AS h FROM embeddings),
p AS (SELECT capture, k, CASE WHEN k = 0 THEN e0 * 4 + CASE WHEN e0 > 0 THEN 0.5 ELSE -0.5 END ELSE e0 * 4 - 4 END AS s, CASE WHEN k = 0 THEN 2 + w ELSE 4 + w END AS o, h FROM e),
a AS (SELECT *, median(o) OVER (PARTITION BY capture, k) AS off, min(h) OVER (PARTITION BY capture, k) AS low, max(h) OVER (PARTITION BY capture, k) AS high FROM p),
g AS (SELECT *, coalesce(s - lag(s) OVER (PARTITION BY capture, k ORDER BY s) > 0.9, true)::INT AS new FROM a),
r AS (SELECT *, sum(new) OVER (PARTITION BY capture, k ORDER BY s ROWS UNBOUNDED PRECEDING) AS run FROM g),
w AS (SELECT capture, k, off, low, high, min(s) AS lo, max(s) AS hi, count(*) AS n FROM r GROUP BY capture, k, off, low, high, run HAVING max(s) - min(s) >= 0.4)
SELECT capture, CASE WHEN k = 0 THEN 0.0 ELSE 1.0 END::DOUBLE AS nx, CASE WHEN k = 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS ny, round(off, 6) AS "offset", round(CASE WHEN k = 0 THEN hi ELSE off END, 6) AS x0, round(CASE WHEN k = 0 THEN off ELSE lo END, 6) AS y0, round(CASE WHEN k = 0 THEN lo ELSE off END, 6) AS x1, round(CASE WHEN k = 0 THEN off ELSE hi END, 6) AS y1, n, round(low, 6) AS low, round(high, 6) AS high, false AS quarantined FROM w""",
}

QUERIES = {f.__name__: f for f in (structural_planes, fitted_walls)}
