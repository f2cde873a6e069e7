"""Faces of wall graphs and outlines of cells, against results worked out by hand or walked along in Python."""

import random

import pytest
from pyspark.sql import functions as F

from plumbline.operators import rings

WALL = "scene string, wall int, x0 double, y0 double, x1 double, y1 double"


def box(scene, x0, y0, x1, y1, k=0):
    return [(scene, k, x0, y0, x1, y0), (scene, k + 1, x1, y0, x1, y1), (scene, k + 2, x1, y1, x0, y1), (scene, k + 3, x0, y1, x0, y0)]


def test_faces_of_plans(spark):
    rows = box("T", 0.0, 0.0, 6.0, 4.0) + [("T", 9, 3.0, 0.03, 3.0, 4.02)]  # a wall between two rooms, short at one end and long at the other
    rows += box("nested", 0.0, 0.0, 10.0, 10.0) + box("nested", 4.0, 4.0, 6.0, 6.0, 10)
    rows += box("dangling", 0.0, 0.0, 3.0, 3.0) + [("dangling", 20, 3.0, 1.0, 5.0, 1.0), ("dangling", 21, 5.0, 1.0, 5.0, 2.0), ("dangling", 22, 1.0, 1.0, 2.0, 2.0)]
    rows += box("bridged", 0.0, 0.0, 2.0, 2.0) + box("bridged", 5.0, 0.0, 7.0, 2.0, 10) + [("bridged", 20, 2.0, 1.0, 5.0, 1.0)]
    rows += box("gap", 0.0, 0.0, 3.0, 3.0)[:3] + [("gap", 3, 0.05, 3.0, 0.0, 0.04)]
    rows += box("open", 0.0, 0.0, 3.0, 3.0)[:3] + [("two", 0, 0.0, 0.0, 1.0, 0.0), ("two", 1, 0.0, 0.0, 0.0, 1.0)]
    rows += box("small", 0.0, 0.0, 1.0, 1.0) + [("small", 9, None, 0.0, 1.0, 1.0), ("small", 10, float("nan"), 0.0, 1.0, 1.0), ("small", 11, 2.0, 2.0, 2.0, 2.0)]
    rows += [("cross", i, float(i) * 2, -1.0, float(i) * 2, 5.0) for i in range(3)] + [("cross", 10 + i, -1.0, float(i) * 2, 5.0, float(i) * 2) for i in range(3)]
    got = rings.wall_faces(spark.createDataFrame(rows, WALL), "scene").collect()
    by = {}
    for r in sorted(got, key=lambda r: (r.scene, -1 if r.face is None else r.face)):
        by.setdefault(r.scene, []).append((round(r.area, 3), round(r.cx, 2), round(r.cy, 2), len(r.polygon), len(r.holes), r.reason))
    assert set(by) == {"T", "nested", "dangling", "bridged", "gap", "small", "cross"}
    assert [round(x[0], 1) for x in by["T"]] == [12.0, 12.0]
    assert by["nested"] == [(4.0, 5.0, 5.0, 4, 0, None), (96.0, 5.0, 5.0, 4, 1, None)]
    assert by["dangling"] == [(9.0, 1.5, 1.5, 5, 0, None)]
    assert [x[0] for x in by["bridged"]] == [4.0, 4.0] and by["gap"][0][0] == 9.0
    assert by["small"] == [(1.0, 0.5, 0.5, 4, 0, "below-min-area")]
    assert [(x[0], x[1], x[2]) for x in by["cross"]] == [(4.0, x, y) for x in (1.0, 3.0) for y in (1.0, 3.0)]


def test_no_walls(spark):
    assert rings.wall_faces(spark.createDataFrame([], WALL), "scene").count() == 0


def test_long_rings_are_ordered(spark):
    order = list(range(5000))
    random.Random(1).shuffle(order)
    steps = list(zip(order, order[1:] + order[:1])) + [(9000, 9000), (9001, 9002), (9002, 9001)]
    got = rings.ring_order(spark.createDataFrame(steps, "id bigint, next bigint")).collect()
    k = order.index(0)
    want = {x: (0, i) for i, x in enumerate(order[k:] + order[:k])} | {9000: (9000, 0), 9001: (9001, 0), 9002: (9001, 1)}
    assert {r.id: (r.ring, r.place) for r in got} == want


def test_rings_over_many_batches(spark):
    """Rings that lie in many Arrow batches, and rings that are whole in one, at once."""
    rng = random.Random(4)
    ids, rings_of = list(range(3000)), []
    rng.shuffle(ids)
    while ids:
        n = rng.choice([1, 2, 3, 40, 700])
        rings_of.append(ids[:n])
        ids = ids[n:]
    steps = [(a, b) for r in rings_of for a, b in zip(r, r[1:] + r[:1])]
    want = {r[(r.index(min(r)) + i) % len(r)]: (min(r), i) for r in rings_of for i in range(len(r))}
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in ("7", "100", old):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            got = rings.ring_order(spark.createDataFrame(steps, "id bigint, next bigint").repartition(3)).collect()
            assert {r.id: (r.ring, r.place) for r in got} == want and len(got) == 3000, size
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_long_rings_take_few_jobs(spark):
    """A ring of 8192 in order took thirteen rounds of joins, whatever lay together."""
    steps = spark.range(8192).selectExpr("id", "(id + 1) % 8192 as next")
    spark.sparkContext.setJobGroup("rings", "rings")
    try:
        assert rings.ring_order(steps).where("ring = 0 and place = id").count() == 8192
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("rings")) < 40
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_faces_do_not_depend_on_squares_and_batches(spark):
    """A plan of 30 by 3 rooms, two metres wide, with a wall end in some, lies in two squares of 64 m and many batches."""
    rows = [("s", i, i * 2.0, -1.0, i * 2.0, 7.0) for i in range(31)] + [("s", 100 + i, -1.0, i * 2.0, 61.0, i * 2.0) for i in range(4)] + [("s", 200 + i, i * 4.0, 1.0, i * 4.0 + 1.0, 1.0) for i in range(10)]
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    found = []
    try:
        for size in ("11", old):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            found.append(sorted((r.face, r.area, r.cx, r.cy, str(r.polygon)) for r in rings.wall_faces(spark.createDataFrame(rows, WALL), "scene").collect()))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert found[0] == found[1] and len(found[0]) == 90
    assert all(abs(r[1] - 4) < 1e-9 for r in found[0])


def walked(cells):
    """Rings of a group's cells as {(start), ...}: area and the number of sides, by walking with the cells to the left."""
    step = [(1, 0), (0, 1), (-1, 0), (0, -1)]
    inside = lambda x, y: (x, y) in cells
    sides = set()
    for u, v in cells:
        for d, (x, y), (a, b) in ((0, (u, v), (u, v - 1)), (1, (u + 1, v), (u + 1, v)), (2, (u + 1, v + 1), (u, v + 1)), (3, (u, v + 1), (u - 1, v))):
            if not inside(a, b):
                sides.add((x, y, d))
    out = []
    while sides:
        first = at = min(sides)
        n = area = 0
        while at in sides:
            sides.discard(at)
            x, y, d = at
            n, area = n + 1, area + x * step[d][1] - y * step[d][0]
            x, y = x + step[d][0], y + step[d][1]
            for turn in (1, 0, 3):
                nxt = (x, y, (d + turn) % 4)
                if nxt in sides or nxt == first:
                    at = nxt
                    break
        out.append((first, n, area / 2))
    return sorted(out)


def test_outlines_of_cells(spark):
    rng = random.Random(3)
    groups = {g: {(rng.randrange(9), rng.randrange(9)) for _ in range(rng.choice([1, 20, 60]))} for g in range(12)}
    rows = [(g, u, v) for g, c in groups.items() for u, v in c]
    got = rings.outline_rings(spark.createDataFrame(rows, "g int, cu int, cv int"), ["g"]).collect()
    for g, cells in groups.items():
        mine = [r for r in got if r.g == g]
        assert sorted((tuple(r.ring), r.n, r.area) for r in mine) == walked(cells)
        assert sum(r.area for r in mine) == len(cells)
        for r in mine:
            assert len(r.points) == r.n
            p = [(q.x, q.y) for q in r.points]
            assert all(abs(a[0] - b[0]) + abs(a[1] - b[1]) == 1 for a, b in zip(p, p[1:] + p[:1]))


def test_rooms_are_rectified(spark):
    wobbly = [(u, v) for u in range(24) for v in range(14) if not (v == 13 and u % 3 == 0)]  # a ragged upper side
    got = rings.outlines(spark.createDataFrame([("a", u, v) for u, v in wobbly], "g string, cu int, cv int"), ["g"], 0.25, (1.0, 2.0)).first()
    xs, ys = [p.x for p in got.polygon], [p.y for p in got.polygon]
    assert len(got.polygon) == 4 and len({round(x, 9) for x in xs}) == 2 and len({round(y, 9) for y in ys}) == 2
    assert got.area == pytest.approx((max(xs) - min(xs)) * (max(ys) - min(ys)))
    assert 0.8 < got.area / (len(wobbly) / 16) < 1.05


def test_polygons_that_cannot_be_rectified(spark):
    p = [{"x": 0.0, "y": 0.0}, {"x": 0.1, "y": 0.0}, {"x": 0.0, "y": 0.1}]
    df = spark.createDataFrame([(p,), ([],)], "p array<struct<x: double, y: double>>")
    out = [[tuple(q) for q in r.p] for r in df.select(rings.rectified(F.col("p")).alias("p")).collect()]
    assert out == [[(0.0, 0.0), (0.1, 0.0), (0.0, 0.1)], []]
