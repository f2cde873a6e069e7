"""Rooms, probes and measurements of small plans, worked out by hand."""

import pytest

from plumbline.operators import scene_measures, segments

WALL = "scene string, wall int, x0 double, y0 double, x1 double, y1 double"
CELL = "scene string, cu bigint, cv bigint, occupied bigint, free bigint"


def box(scene, x0, y0, x1, y1, k=0):
    return [(scene, k, x0, y0, x1, y0), (scene, k + 1, x1, y0, x1, y1), (scene, k + 2, x1, y1, x0, y1), (scene, k + 3, x0, y1, x0, y0)]


def floor(scene, us, vs, free=5):
    return [(scene, u, v, 0, free) for u in us for v in vs]


def test_rooms_of_plans(spark):
    walls = box("flat", 0.0, 0.0, 8.0, 4.0) + [("flat", 9, 4.0, 0.0, 4.0, 4.0)]  # two rooms, floor seen in both
    walls += box("half", 0.0, 0.0, 8.0, 4.0) + [("half", 9, 4.0, 0.0, 4.0, 4.0)]  # floor seen in one
    walls += box("blind", 0.0, 0.0, 4.0, 4.0)
    walls += box("open", 0.0, 0.0, 4.0, 4.0)[:3]  # bounds nothing: what was seen of the floor is the room
    cells = floor("flat", range(2, 5), range(2, 4)) + floor("flat", range(10, 14), range(2, 4)) + floor("half", range(2, 5), range(2, 4)) + floor("blind", range(30, 33), [2], 1)
    cells += floor("open", range(1, 7), range(1, 5)) + floor("open", [9], [0]) + [("open", 7, 1, 9, 9)]
    rooms, scenes = segments.segmented_rooms(spark.createDataFrame(cells, CELL), spark.createDataFrame(walls, WALL), "scene", 0.5)
    got = {(r.scene, r.room): (r.name, r.source, round(r.area, 6), round(r.cx, 6), round(r.cy, 6), r.walls, r.neighbours) for r in rooms.collect()}
    assert got == {
        ("flat", 0): ("room_1", "wall-face", 16.0, 2.0, 2.0, [0, 2, 3, 9], [1]),
        ("flat", 1): ("room_2", "wall-face", 16.0, 6.0, 2.0, [0, 1, 2, 9], [0]),
        ("half", 0): ("room_1", "wall-face", 16.0, 2.0, 2.0, [0, 2, 3, 9], None),
        ("open", 0): ("room_1", "floor-component", 6.0, 2.0, 1.5, None, None),
    }
    why = {r.scene: (r.n, r.fallback, r.reason) for r in scenes.collect()}
    assert why["flat"] == (2, False, None) and why["open"] == (1, True, None)
    assert why["blind"] == (0, True, "candidate-faces-have-no-observed-floor; no-observed-free-cells")


def test_rasters_and_probes(spark):
    walls = spark.createDataFrame([("a", 0, 0.0, 1.0, 2.0, 1.0)], WALL)
    size = spark.createDataFrame([("a", 0.0, 0.0, 5, 3)], "scene string, u0 double, v0 double, columns int, rows int")
    cells = {(r.cu, r.cv) for r in segments.rasterised_walls(walls, "scene", 0.5, size).collect()}
    assert cells == {(u, v) for u in range(5) for v in (1, 2)}  # the third row of the band is beyond the grid
    labels = spark.createDataFrame([("a", u, v, v) for u in range(4) for v in (1, 2)], "scene string, cu bigint, cv bigint, room int")
    assert {(r.room, r.hits) for r in segments.probed_walls(walls, labels, "scene", 0.5).collect()} == {(1, 4), (2, 4)}


EVIDENCE = {"rms": 0.01, "points": 900, "density": 100.0, "pose": "slam", "depth": "lidar", "calibration": "calibrated", "pose_sigma": 0.0}
E = "struct<rms: double, points: bigint, density: double, pose: string, depth: string, calibration: string, pose_sigma: double>"


def test_measurements(spark):
    side = lambda k, nx, ny, o, ends, seen=True: ("s", k, nx, ny, o, *ends, 0.1, 2.5, EVIDENCE, seen, 0.0)
    none = (None, None, None, None)
    walls = spark.createDataFrame([
        side(0, 0.0, 1.0, 0.0, (0.0, 0.0, 4.0, 0.0)), side(1, 1.0, 0.0, 4.0, none), side(2, 0.0, 1.0, 3.0, (4.0, 3.0, 0.0, 3.0)), side(3, 1.0, 0.0, 0.0, none),
        side(4, 0.0, 1.0, -0.2, (1.0, -0.2, 4.0, -0.2)), side(5, 0.0, 1.0, 3.3, (0.0, 3.3, 4.0, 3.3), False),
    ], f"scene string, wall int, nx double, ny double, offset double, x0 double, y0 double, x1 double, y1 double, low double, high double, e {E}, observed boolean, inferred double")
    meetings = spark.createDataFrame([("s", 1, 0, 4.0, 0.0), ("s", 1, 2, 4.0, 3.0), ("s", 3, None, 0.0, float("nan"))], "scene string, a int, b int, x double, y double")
    records = scene_measures.wall_records(walls, meetings, "scene")
    got = {r.wall: r for r in scene_measures.measured_walls(records, "scene").collect()}
    assert {k: r.geometry_source for k, r in got.items()} == {0: "phase1_plane_endpoints", 1: "supplied_plane_intersections", 2: "phase1_plane_endpoints", 3: "unmeasured", 4: "phase1_plane_endpoints", 5: "phase1_plane_endpoints"}
    assert got[1].length.value == 3.0 and got[1].length.flags == [] and got[3].length.value is None and "plane_extent_missing" in got[3].length.flags
    assert got[0].length.tolerance == pytest.approx(1.645 * 0.0175) and "open_ended_geometry" in got[0].length.flags
    assert got[0].thickness.value == pytest.approx(0.2) and got[0].opposing == 4 and got[2].thickness.value is None  # the face outside of wall 2 was not seen
    polygon = [{"x": x, "y": y} for x, y in ((0.0, 0.0), (4.0, 0.0), (4.0, 3.0), (0.0, 3.0))]
    room = lambda i, p, status=None, source=None, sure=None, ws=(0, 1, 2, 3): ("s", i, p, status, source, sure, list(ws), EVIDENCE)
    rooms = spark.createDataFrame([room(0, polygon), room(1, polygon, "rejected"), room(2, polygon, None, "Flood fill"), room(3, polygon, None, None, 0.3), room(4, None), room(5, polygon[:2]), room(6, polygon, ws=(0,)), room(7, [])], f"scene string, room int, polygon array<struct<x: double, y: double>>, status string, source string, confidence double, walls array<int>, e {E}")
    out = {r.room: r for r in scene_measures.measured_rooms(rooms, records, scene_measures.measured_walls(records, "scene"), "scene").collect()}
    assert {k: r.boundary_source for k, r in out.items()} == {0: "supplied_bounded_face", 1: "unmeasured", 2: "raster_rejected", 3: "low_confidence", 4: "unmeasured", 5: "invalid", 6: "supplied_bounded_face", 7: "invalid"}
    assert out[0].interior.value == 12.0 and out[0].interior.status == "measured" and out[0].outer.status == "estimated"
    # 0.2 measured below, 0.15 taken for the other three sides
    assert out[0].centreline.value == pytest.approx((4 + 0.15) * (3 + 0.175)) and out[0].outer.value == pytest.approx((4 + 0.3) * (3 + 0.35))
    assert out[6].centreline.value == pytest.approx(4.15 * 3.15) and out[1].interior.value is None and out[1].interior.status == "unmeasured"
