"""Residuals and depth gates against results worked out by hand."""

import pytest

from plumbline.operators import attribution

WALLS = [(1, 7, 1.0, 0.0, 2.0, 2.0, 0.0, 0.0, 1.0, 4.0), (1, 8, 0.0, 1.0, 9.0, 0.0, 9.0, 1.0, 0.0, 1.4), (2, 9, 1.0, 0.0, 2.0, 2.0, 0.0, 0.0, 1.0, 4.0)]
WALL = "capture int, wall int, nx double, ny double, offset double, sx double, sy double, dx double, dy double, length double"
POINT = "capture int, id int, x double, y double, rx double, ry double, range double, confidence int, t double"


def observed(spark, rows):
    return spark.createDataFrame([(1, i, *r) for i, r in enumerate(rows)], POINT).repartition(3)


def test_points_beside_walls(spark):
    rows = [(2.05, 0.01), (1.95, 3.99), (2.0, 2.25), (2.07, 2.0), (2.0, -0.01), (2.0, 4.01), (0.7, 9.0), (-2.0, 2.0)]
    points = observed(spark, [(x, y, 1.0, 0.0, 1.0, 1, 0.0) for x, y in rows])
    walls = spark.createDataFrame(WALLS, WALL)
    got = sorted((r.id, r.wall, r.signed, r.wall_length) for r in attribution.beside_walls(points, walls, 0.06).collect())
    assert got == [(0, 7, 5000, 4.0), (1, 7, -5000, 4.0), (2, 7, 0, 4.0)]  # the wall of 1.4 m is too short, wall 9 is elsewhere
    assert [r.id for r in attribution.beside_walls(points, walls, 0.06, margin=0.1).collect()] == [2]
    assert attribution.beside_walls(points.limit(0), walls, 0.06).count() == 0
    with pytest.raises(ValueError):
        attribution.beside_walls(points, walls, 0.3)


def test_residuals_have_the_rays_sign(spark):
    points = observed(spark, [(1.99, 1.0, 1.0, 0.0, 1.0, 0, 0.0), (2.01, 1.0, 1.0, 0.0, 2.0, 0, 0.0), (2.03, 2.0, -0.6, 0.8, 3.0, 0, 0.0)])
    near = attribution.beside_walls(points, spark.createDataFrame(WALLS, WALL), 0.06)
    got = sorted((r.range, round(r.residual, 6), r.incidence) for r in attribution.residuals(near, 3).collect())
    assert got == [(1.0, -0.02, 1.0), (2.0, 0.0, 1.0), (3.0, -0.02, 0.6)]
    assert attribution.residuals(near, 4).count() == 0


def test_attribution_finds_a_scale_error(spark):
    """The residual grows by 10 mm for each metre of range; the greatest range falls out of the last bin."""
    pooled = spark.range(1001).selectExpr("(id / 250 + 1 - 3) * 0.01D AS residual", "id / 250 + 1 AS range", "0.5D AS incidence", "CAST(id % 4 AS INT) AS confidence")
    out = attribution.attribution(pooled, 100)
    rows = out.orderBy("factor", "bin").collect()
    assert [(r.factor, r.bin, r.n) for r in rows] == [("confidence", 0, 251), ("confidence", 1, 250), ("confidence", 2, 250), *[("range", i, 100) for i in range(1, 11)]]
    assert abs(rows[3].centre - 1.2) < 1e-9 and abs(rows[3].median - (rows[3].centre - 3 - 0.002) * 0.01) < 1e-9
    got = attribution.slope(out).first()
    assert abs(got.slope_mm_per_m - 10) < 1e-6 and abs(got.span_mm - 36) < 1e-6
    assert attribution.slope(out.where("bin < 3")).count() == 0


def test_gates_split_visits_by_what_they_keep(spark):
    rows = [(2.00, 1.0, 1, t) for t in (0.0, 1.0)] + [(2.01, 1.0, 2, t) for t in (2.0, 3.0)] + [(2.02, 1.0, 2, t) for t in (20.0, 21.0)] + [(2.03, 1.0, 1, 11.0)]
    points = observed(spark, [(x, y, 1.0, 0.0, 2.0, c, t) for x, y, c, t in rows])
    got = attribution.gating_sweep(points, spark.createDataFrame(WALLS, WALL), [(1, 5.0), (2, 5.0), (2, 1.0)], gap=9.5, least=2).orderBy("gate").collect()
    # gate 0 keeps one visit (the point at 11 s fills the gap), gate 1 two of 2.01 and 2.02
    assert [(r.points, r.walls, r.revisited) for r in got] == [(7, 1, 0), (4, 1, 1), (0, 0, 0)]
    assert got[0].drift_median_mm is None and abs(got[1].drift_median_mm - 10) < 1e-9 and got[1].coverage_change == 0
    assert got[2].wall_m is None and got[2].min_confidence == 2 and got[2].max_range == 1.0
