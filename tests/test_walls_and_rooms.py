"""Wall folds, rooms, scores and sinks against results worked out by hand."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.operators import joins, rooms, scoring, walls
from plumbline.sources import sinks

WALL = "plan string, wall int, nx double, ny double, offset double, x0 double, y0 double, x1 double, y1 double, inliers long, rms double, seen0 double, seen1 double, low double, high double, tags array<string>, quarantined boolean"


def wall(i, a, b, inliers=600, quarantined=False, tags=()):
    a, b = np.array(a, float), np.array(b, float)
    d = (b - a) / np.linalg.norm(b - a)
    n = np.array([-d[1], d[0]])
    return ("p", i, *map(float, n), float(n @ a), *map(float, a), *map(float, b), inliers, 0.004, 0.0, float(np.linalg.norm(b - a)), 0.2, 2.4, list(tags), quarantined)


def table(spark, *rows):
    return spark.createDataFrame(list(rows), WALL)


def test_collinear_walls_merge(spark):
    got = walls.merge_collinear(table(spark, wall(1, (0, 0), (4, 0), 900), wall(2, (3.8, 0.03), (6, 0.03), 300), wall(3, (1, 0.2), (2, 0.2), 100), wall(4, (0, 2), (4, 2), 200), wall(5, (7, 0.0), (8, 0.0), 50), wall(6, (0, 0.01), (1, 0.01), 10, True))).orderBy("place").collect()
    assert [r.wall for r in got] == [1, 4, 6, 5] or [r.wall for r in got] == [1, 4, 5, 6]
    first = got[0]
    assert first.inliers == 1200 and first.offset == pytest.approx((900 * 0 + 300 * 0.03) / 1200) and first.x1 == pytest.approx(6.0) and first.tags == ["clutter-in-front"] and first.seen1 == pytest.approx(6.0)


def test_crossings_are_resolved(spark):
    got = {r.wall: r for r in walls.resolve_crossings(table(spark, wall(1, (0, 0), (4, 0), 900), wall(2, (2, -0.3), (2, 3), 300), wall(3, (3, 9), (4, 9), 5, True))).collect()}
    assert set(got) == {1, 2} and (got[2].x0, got[2].y0) == (pytest.approx(2.0), pytest.approx(0.0)) and got[2].tags == ["trimmed-at-junction"] and got[2].seen1 == pytest.approx(3.0)
    got = walls.resolve_crossings(table(spark, wall(1, (0, 0), (4, 0), 900), wall(2, (2, -2), (2, 3), 300))).collect()
    assert [r.wall for r in got] == [1]


def test_corners_snap(spark):
    got = {r.wall: r for r in walls.snap_corners(table(spark, wall(1, (0.2, 0), (4, 0)), wall(2, (0, 0.3), (0, 3)), wall(3, (9, 9), (9, 12)))).collect()}
    assert (got[1].x0, got[1].y0) == (pytest.approx(0), pytest.approx(0)) and (got[2].x0, got[2].y0) == (pytest.approx(0), pytest.approx(0))
    assert got[1].tags == ["corner-start"] and got[3].tags == [] and got[3].y1 == 12.0


def poly(*p):
    return [{"x": float(x), "y": float(y)} for x, y in p]


def test_rooms(spark):
    ell = poly((0, 0), (4, 0), (4, 2), (2, 2), (2, 4), (0, 4))
    assert rooms.overlap_area(np.array([(0, 0), (4, 0), (4, 2), (2, 2), (2, 4), (0, 4)]), np.array([(1, 1), (3, 1), (3, 3), (1, 3)])) == pytest.approx(3.0)
    df = spark.createDataFrame([("s", 1, ell), ("s", 2, poly((3, 3), (1, 3), (1, 1), (3, 1))), ("s", 3, poly((4, 0), (8, 0), (8, 2), (4, 2))), ("s", 4, poly((0, 0), (1, 1)))], "scene string, id int, polygon array<struct<x:double,y:double>>")
    assert [(r.a, r.b, round(r.fraction, 6)) for r in rooms.room_overlaps(df, "scene").collect()] == [(1, 2, 0.75)]
    listed = spark.createDataFrame([("s", 1, [2, 1, 9]), ("s", 2, []), ("s", 3, [2])], "scene string, id int, neighbours array<int>")
    edges = spark.createDataFrame([("s", 1, 2), ("s", 1, 7)], "scene string, a int, b int")
    got = {(r.room, r.other, r.error) for r in rooms.adjacency_errors(listed, edges, "scene").collect()}
    assert got == {(1, 1, "self"), (1, 9, "unknown"), (1, 2, "asymmetric"), (3, 2, "asymmetric"), (1, 7, "edge to unknown room")}
    members = spark.createDataFrame([("s", 10, 1), ("s", 10, 2), ("s", 11, 2), ("s", 10, 1)], "scene string, wall int, room int")
    assert sorted((r.room, r.other) for r in rooms.room_neighbours(members, "scene").collect()) == [(1, 2), (2, 1)]
    free = spark.createDataFrame([("s", 3.5, 3.5), ("s", 6.0, 1.0), ("t", 1.0, 1.0)], "scene string, x double, y double")
    assert sorted(r.id for r in rooms.observed_rooms(df.where("id <> 4"), free, "scene").collect()) == [3]
    lines = spark.createDataFrame([("s", 1, 0.0, 0.0, 4.0, 0.0), ("s", 2, 4.0, 0.5, 4.0, 1.5), ("s", 3, 0.0, 0.3, 4.0, 0.3)], "scene string, wall int, x0 double, y0 double, x1 double, y1 double")
    got = {(r.wall, r.room): r.shared for r in rooms.shared_boundary(lines, df.where("id in (1, 3)"), "scene").collect()}
    assert got == {(1, 1): 4.0, (2, 1): 1.0, (2, 3): 1.0}


def test_names_and_ways(spark):
    named = spark.createDataFrame([("s", 1, "room_1", 2.0, 1.5, 5, 4.0, 0.0, 1.0, 2.0, 3.0), ("s", 1, "room_1", 2.0, 1.5, 6, 1.0, 0.0, -1.0, 1.0, 3.0), ("s", 1, "room_1", 2.0, 1.5, 7, 3.0, 1.0, 0.0, 0.0, 1.5)], "scene string, room int, room_name string, rx double, ry double, wall int, length double, nx double, ny double, mx double, my double")
    assert {r.wall: r.name for r in rooms.wall_names(named, "scene").collect()} == {5: "room_1.north_wall", 6: "room_1.north_wall_2", 7: "room_1.west_wall"}
    edges = spark.createDataFrame([("s", 1, 2, 0.0, 0.0), ("s", 1, 3, 9.0, 9.0)], "scene string, a int, b int, x double, y double")
    doors = spark.createDataFrame([("s", 0, "door", 2, "w1", 0.5, 0.0), ("s", 1, "window", 1, "w2", 0.1, 0.0), ("s", 2, "pass-through", 1, "w3", 1.0, 0.0), ("s", 3, "door", 3, "w4", 9.0, 7.8)], "scene string, place int, kind string, room int, name string, mx double, my double")
    assert {(r.a, r.b): r.via for r in rooms.adjacency_via(edges, doors, "scene").collect()} == {(1, 2): "w1", (1, 3): None}


def test_scores(spark):
    c = spark.createDataFrame([("wall_length", 4.0, 4.03, 0.05), ("wall_length", 1.0, 1.03, 0.01), ("floor_area", 10.0, 10.1, 0.5)], "kind string, truth double, predicted double, half_width double")
    got = {r.gate: (r.passing, r.total, r.passed) for r in scoring.gate_table(c).collect()}
    assert got == {"wall_length": (1, 2, False), "wall_length_stretch": (0, 2, False), "floor_area": (1, 1, True)}
    rep = {r.kind: r for r in scoring.interval_report(c).collect()}
    assert rep["wall_length"].median_error_mm == 30.0 and rep["wall_length"].observed == 0.5 and not rep["wall_length"].calibrated
    regions = spark.createDataFrame([("a", "water", 2.0, 1, 2, 3), ("a", "water", 1.0, 2, 3, 3), ("b", "fire", 9.0, 3, None, None)], "surface string, damage_class string, area double, id int, water_category int, water_class int")
    ref = spark.createDataFrame([("a", "2", "3"), ("a", "", "1"), ("b", "2", None), ("c", None, "")], "surface string, water_category string, water_class string")
    assert tuple(scoring.water_scores(regions, ref).first()) == (1, 3, 0.3333, False)
    area = spark.createDataFrame([(10.0,), (None,), (9.9,)], "area double")
    assert tuple(scoring.footprint_error(area, 20.0).first()) == (19.9, 0.005, 1, True)


def test_bucketed_joins(spark):
    rng = np.random.default_rng(3)
    a, b = rng.uniform(-5, 5, 60), rng.uniform(-5, 5, 60)
    left = spark.createDataFrame([(i, float(v)) for i, v in enumerate(a)], "i int, v double")
    right = spark.createDataFrame([(j, float(w)) for j, w in enumerate(b)], "j int, w double")
    gap = F.abs(F.col("v") - F.col("w"))
    got = {r.i: r.j for r in joins.best_within(left, "i", F.col("v"), right, F.col("w"), 0.3, [gap, F.col("j")], ["j"]).collect()}
    assert got == {i: int(np.argmin(abs(b - v))) for i, v in enumerate(a) if abs(b - v).min() <= 0.3}


def test_sinks(spark, tmp_path):
    w = spark.createDataFrame([(1, 7, "n", 3.14159, 0.02, 0.9, None, 2.2, None, None), (2, 99, "x", None, None, None, "unmeasured", None, 0.15, "assumed")], "wall int, room_id int, name string, length double, half_width double, confidence double, status string, extent double, thickness double, thickness_status string")
    r = spark.createDataFrame([(7, "Kitchen", 12.0, 2.5, 11.9, 0.8, None, None, 2.4, 2.5, 2.6)], "room_id int, room_name string, area double, ceiling_height double, interior_area double, interior_confidence double, centerline_area double, outer_area double, height_min double, height_mean double, height_max double")
    rows = {x.wall: x for x in sinks.sketch_rows(w, r).collect()}
    assert len(rows["n"]) == 18 and (rows["n"].room, rows["n"].wall_length_m, rows["n"].wall_length_status, rows["n"].room_wall_centerline_area_m2, rows["n"].height_mean_m) == ("Kitchen", "3.142", "measured", "", "2.500")
    assert (rows["x"].room, rows["x"].wall_length_m, rows["x"].wall_thickness_m, rows["x"].wall_thickness_status) == ("", "", "0.150", "assumed")
    planes = spark.createDataFrame([("c", 2, "wall"), ("c", 1, "floor")], "capture string, id int, kind string")
    assert json.loads(sinks.plane_document(planes, "capture").first().document) == {"planes": [{"id": 1, "kind": "floor"}, {"id": 2, "kind": "wall"}]}
    assert json.loads(sinks.manifest_documents(spark.createDataFrame([("x", None)], "status string, error string")).first().document) == {"status": "x", "error": None}
