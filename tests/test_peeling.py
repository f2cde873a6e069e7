"""Planted planes and walls come back, one a round, and ends are clean."""

import random

import pytest

from plumbline.operators import peeling


def room(seed, capture):
    """A room of 4 x 3 x 2.5 m with a table, slanted roof and noise: rows (capture, id, x, y, z)."""
    rng = random.Random(seed)
    j = lambda: rng.uniform(-0.01, 0.01)
    u = rng.uniform
    rows = [(u(0, 4), u(0, 3), j()) for _ in range(900)] + [(u(0, 4), u(0, 3), 2.5 + j()) for _ in range(700)]
    rows += [(j(), u(0, 3), u(0.1, 2.4)) for _ in range(600)] + [(u(0, 4), 3 + j(), u(0.1, 2.4)) for _ in range(500)]
    rows += [(u(1, 2), u(1, 2), 0.8 + j()) for _ in range(300)]
    rows += [(u(5, 8), y := u(0, 3), 1.0 + y + j()) for _ in range(250)]
    rows += [(u(-5, 9), u(-5, 9), u(-3, 6)) for _ in range(60)] + [(float("nan"), 0.0, 0.0), (None, 0.0, 1.0)]
    return [(capture, i, *p) for i, p in enumerate(rows)]


def test_planted_planes(spark):
    rows = room(1, "a") + room(2, "b") + [("few", i, float(i), 0.0, 0.0) for i in range(10)] + [("line", i, i * 0.1, 0.0, 0.0) for i in range(80)]
    df = spark.createDataFrame(rows, "capture string, id int, x double, y double, z double").repartition(3)
    got = peeling.structural_planes(df, "capture", least=100, most=8, tries=300, pool=800).collect()
    for c in "ab":
        kinds = sorted(r.kind for r in got if r.capture == c)
        assert kinds == ["ceiling", "clutter", "clutter", "floor", "wall", "wall"]
        by = {k: [r for r in got if r.capture == c and r.kind == k] for k in kinds}
        floor, ceiling = by["floor"][0], by["ceiling"][0]
        assert floor.nz == pytest.approx(1, abs=0.01) and floor.offset == pytest.approx(0, abs=0.01) and 890 <= floor.n <= 960
        assert ceiling.nz == pytest.approx(-1, abs=0.01) and ceiling.offset == pytest.approx(-2.5, abs=0.02)
        assert sorted(round(abs(w.nx) + 2 * abs(w.ny)) for w in by["wall"]) == [1, 2]
        assert sorted(round(abs(r.nz), 1) for r in by["clutter"]) == [0.7, 1.0] and all(r.quarantined for r in by["clutter"])
        assert all(0.5 < r.confidence <= 1 and 0 < r.rms < 0.02 and r.median_abs <= r.largest <= 0.04 for r in got if r.capture == c)
    assert {r.capture for r in got} == {"a", "b"}


def test_members_are_of_one_plane(spark):
    df = spark.createDataFrame(room(3, 7), "capture int, id int, x double, y double, z double")
    planes, members = peeling.peeled_planes(df, "capture", least=100, most=3, tries=200)
    assert [r.plane for r in planes.orderBy("plane").collect()] == [0, 1, 2]  # one a round, the best supported first
    ids = [r.id for r in members.collect()]
    assert len(ids) == len(set(ids)) and {r.plane: r["count"] for r in members.groupBy("plane").count().collect()} == {r.plane: r.n for r in planes.collect()}


def test_no_points(spark):
    none = spark.createDataFrame([], "capture int, id int, x double, y double, z double")
    planes, members = peeling.peeled_planes(none, "capture")
    assert planes.count() == 0 and members.count() == 0
    assert peeling.fitted_walls(none.withColumnRenamed("z", "h"), "capture").count() == 0


def test_planted_walls(spark):
    rng = random.Random(5)
    u, j = rng.uniform, lambda: rng.uniform(-0.008, 0.008)
    rows = [(x, 2 + j(), u(0.4, 1.9)) for x in [u(0, 2) for _ in range(700)] + [u(3, 5) for _ in range(700)]]  # a doorway at 2 to 3
    rows += [(5 + j(), u(0, 1.95), u(0.4, 1.9)) for _ in range(800)]
    t = [u(0, 2) for _ in range(600)]
    rows += [(-3 + a * 0.8 + j(), a * 0.6 + j(), u(0.4, 1.9)) for a in t]  # 37 degrees
    rows += [(u(-9, -4), u(-9, -4), u(0.4, 1.9)) for _ in range(300)]
    df = spark.createDataFrame([("p", i, *r) for i, r in enumerate(rows)], "plan string, id int, x double, y double, h double").repartition(3)
    got = peeling.fitted_walls(df, "plan", tries=200).collect()
    assert sorted(r.wall for r in got) == [0, 1, 2, 3]
    level = sorted((r for r in got if r.ny == 1.0), key=lambda r: min(r.x0, r.x1))
    assert [round(min(r.x0, r.x1)) for r in level] == [0, 3] and all(r.offset == pytest.approx(2, abs=0.005) and not r.quarantined for r in level)
    upright = next(r for r in got if r.nx == 1.0)
    assert upright.offset == pytest.approx(5, abs=0.005) and abs(upright.y1 - upright.y0) == pytest.approx(1.95, abs=0.05)
    slanted = next(r for r in got if r.quarantined)
    assert abs(slanted.nx) == pytest.approx(0.6, abs=0.02) and slanted.n >= 560
    assert all(r.low == pytest.approx(0.4, abs=0.02) and r.high == pytest.approx(1.9, abs=0.02) for r in got)
