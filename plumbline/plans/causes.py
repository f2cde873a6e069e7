"""Queries of the causes of wall residuals and of depth gates, with their SQL.

Twenty suppliers are the walls of a capture, the line items its observations.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import attribution
from ..sources.tables import table
from .series import r6

GATES = [(1, 5.0), (2, 5.0), (1, 3.5), (2, 3.5), (2, 2.5)]
_WALL = """s_suppkey div 20 AS capture, s_suppkey AS wall, (s_suppkey % 2 = 0) AS up, 0.5D + (s_suppkey * 7 % 45) * 0.1D AS at, 1.2D + s_suppkey % 4 AS length"""
_POINT = """l_suppkey div 20 AS capture, l_orderkey * 8 + l_linenumber AS id, l_quantity * 0.1D + (CAST(l_extendedprice * 100 AS BIGINT) % 97 - 48) * 0.0013D AS x,
(l_orderkey % 50) * 0.1D + (l_partkey % 89 - 44) * 0.0013D AS y, 0.5D + l_extendedprice / 25000 AS range, CAST(l_linenumber % 3 AS INT) AS confidence,
CAST(datediff(l_shipdate, DATE '1992-01-01') AS DOUBLE) AS t, (l_partkey % 41 - 20.25D) / 20.5D AS rx"""


def _inputs(s, d):
    up = F.col("up")
    n, m = F.when(up, 1.0).otherwise(0.0), F.when(up, 0.0).otherwise(1.0)
    walls = table(s, d, "supplier").selectExpr(*_fields(_WALL))
    walls = walls.select("capture", "wall", n.alias("nx"), m.alias("ny"), F.col("at").alias("offset"), F.when(up, F.col("at")).otherwise(0.2).alias("sx"), F.when(up, 0.2).otherwise(F.col("at")).alias("sy"), m.alias("dx"), n.alias("dy"), "length")
    points = table(s, d, "lineitem").selectExpr(*_fields(_POINT))
    return points.withColumn("ry", F.sqrt(1 - F.col("rx") * F.col("rx"))), walls


def _fields(text: str) -> list[str]:
    """The fields of a select list; none holds a comma outside brackets."""
    out, depth, last = [], 0, 0
    for i, c in enumerate(text):
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append(text[last:i])
            last = i + 1
    return [*out, text[last:]]


def _trend(s, d):
    points, walls = _inputs(s, d)
    return attribution.attribution(attribution.residuals(attribution.beside_walls(points, walls, 0.06), 20), 50)


def residual_attribution(s, d):
    """Medians and quartile ranges of wall residuals by range, incidence and confidence."""
    return _trend(s, d).select("factor", "bin", *r6("centre", "median", "iqr"), "n")


def residual_slope(s, d):
    """How far walls move for each metre of range."""
    return attribution.slope(_trend(s, d)).select(*r6("slope_mm_per_m", "offset_mm", "span_mm"))


def gating_sweep(s, d):
    """What five depth gates keep, and the drift of walls under each against the first."""
    points, walls = _inputs(s, d)
    out = attribution.gating_sweep(points, walls, GATES, gap=30.0, least=4)
    return out.select("gate", "min_confidence", "points", "walls", "revisited", *r6("max_range", "wall_m", "drift_median_mm", "drift_p90_mm", "drift_change", "coverage_change"))


_D = "::DOUBLE"
_SQL = f"""w AS (SELECT s_suppkey // 20 AS capture, s_suppkey AS wall, s_suppkey % 2 = 0 AS up, 0.5{_D} + (s_suppkey * 7 % 45) * 0.1{_D} AS place, 1.2{_D} + s_suppkey % 4 AS length FROM supplier),
p AS (SELECT l_suppkey // 20 AS capture, l_orderkey * 8 + l_linenumber AS id, l_quantity * 0.1{_D} + ((trunc(l_extendedprice * 100))::BIGINT % 97 - 48) * 0.0013{_D} AS x,
  (l_orderkey % 50) * 0.1{_D} + (l_partkey % 89 - 44) * 0.0013{_D} AS y, 0.5{_D} + l_extendedprice / 25000 AS range, l_linenumber % 3 AS confidence,
  date_diff('day', DATE '1992-01-01', l_shipdate::DATE)::DOUBLE AS t, (l_partkey % 41 - 20.25{_D}) / 20.5{_D} AS rx FROM lineitem),
o AS (SELECT p.*, wall, length, CASE WHEN up THEN x ELSE y END - place AS off, CASE WHEN up THEN y ELSE x END - 0.2{_D} AS run, CASE WHEN up THEN rx ELSE sqrt(1 - rx * rx) END AS facing FROM p JOIN w ON p.capture = w.capture)"""
_STEPS = "floor({} / {}::DOUBLE + 0.5::DOUBLE)::BIGINT".format
_EDGES = lambda n: "[" + ", ".join(f"quantile_cont(x, {i} / {n}.0::DOUBLE)" for i in range(n + 1)) + "]"


def _bins(factor: str, n: int, step: str) -> str:
    return f"""SELECT '{factor}' AS factor, bin, any_value((e[bin] + e[bin + 1]) / 2 * {step}{_D}) AS centre, median(residual) AS median, quantile_cont(residual, 0.75) - quantile_cont(residual, 0.25) AS iqr, count(*) AS n
FROM (SELECT x, residual, e, len(list_filter(e, lambda v: v <= x)) AS bin FROM (SELECT {_STEPS(factor, step)} AS x, residual FROM r),
(SELECT list_sort(list_distinct({_EDGES(n)})) AS e FROM (SELECT {_STEPS(factor, step)} AS x FROM r))) WHERE bin < len(e) GROUP BY bin HAVING count(*) >= 50"""


_TREND = f"""WITH {_SQL}, n AS (SELECT *, {_STEPS("off", "1e-5")} AS signed FROM o WHERE abs(off) < 0.06 AND run > 0 AND run < length AND length >= 1.5),
m AS (SELECT wall, median(signed) AS mid FROM n GROUP BY wall HAVING count(*) >= 20),
r AS (SELECT (signed - mid) * sign(facing) * 1e-5{_D} AS residual, range, abs(facing) AS incidence, confidence FROM n JOIN m ON n.wall = m.wall),
trend AS ({_bins("range", 10, "1e-3")} UNION ALL {_bins("incidence", 8, "1e-4")} UNION ALL
SELECT 'confidence', confidence, confidence{_D}, median(residual), quantile_cont(residual, 0.75) - quantile_cont(residual, 0.25), count(*) FROM r GROUP BY confidence HAVING count(*) >= 50)"""

ORACLES = {
    "residual_attribution": f"{_TREND} SELECT factor, bin, round(centre, 6) AS centre, round(median, 6) AS median, round(iqr, 6) AS iqr, n FROM trend",
    "residual_slope": f"""{_TREND} SELECT round(regr_slope(median, centre) * 1000, 6) AS slope_mm_per_m, round(regr_intercept(median, centre) * 1000, 6) AS offset_mm,
round(abs(regr_slope(median, centre)) * (max(centre) - min(centre)) * 1000, 6) AS span_mm FROM trend WHERE factor = 'range' HAVING count(*) > 2""",
    "gating_sweep": f"""WITH {_SQL}, g AS (SELECT * FROM (VALUES {", ".join(f"({i}, {c}, {r}{_D})" for i, (c, r) in enumerate(GATES))}) AS g(gate, c, r)),
n AS (SELECT gate, wall, length, id, t, {_STEPS("off", "1e-5")} AS signed FROM o JOIN g ON confidence >= c AND range <= r WHERE abs(off) < 0.04 AND run > 0.15 AND run < length - 0.15{_D} AND length >= 1.5),
j AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY gate, wall ORDER BY t, id) > 30 THEN 1 ELSE 0 END AS jump FROM n),
v AS (SELECT *, sum(jump) OVER (PARTITION BY gate, wall ORDER BY t, id) AS visit FROM j),
e AS (SELECT gate, wall, length, visit, median(signed) AS mid, count(*) AS m FROM v GROUP BY ALL),
a AS (SELECT gate, wall, length, CASE WHEN count(*) FILTER (m >= 4) >= 2 THEN max(mid) FILTER (m >= 4) - min(mid) FILTER (m >= 4) END AS spread FROM e GROUP BY ALL HAVING sum(m) >= 4),
f AS (SELECT gate, count(*) AS walls, sum(length) AS wall_m, count(spread) AS revisited, median(spread) * 0.01 AS dm, quantile_cont(spread, 0.9) * 0.01 AS dp FROM a GROUP BY gate),
k AS (SELECT gate, c, r, count(*) FILTER (confidence >= c AND range <= r) AS points FROM p, g GROUP BY ALL)
SELECT k.gate, c AS min_confidence, points, coalesce(walls, 0) AS walls, coalesce(revisited, 0) AS revisited, r AS max_range, round(wall_m, 6) AS wall_m, round(dm, 6) AS drift_median_mm, round(dp, 6) AS drift_p90_mm,
round(100 * (1 - dm / nullif((SELECT dm FROM f WHERE gate = 0), 0)), 6) AS drift_change, round(100 * (wall_m / (SELECT wall_m FROM f WHERE gate = 0) - 1), 6) AS coverage_change FROM k LEFT JOIN f ON k.gate = f.gate""",
}

QUERIES = {f.__name__: f for f in (residual_attribution, residual_slope, gating_sweep)}
