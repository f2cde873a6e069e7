"""Detections become regions; fused openings and hints, against results worked out by hand."""

import pytest

from plumbline.operators import damage, openings

EYE = [0.0, 0.0, 1.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, -1.0, 0.0, 1.2, 0.0, 0.0, 0.0, 1.0]  # looks along x


def capture(spark, boxes, depth=lambda u, v: 2.0):
    """A camera at a height of 1.2 before a wall 2 m away, 64 x 48 pixels; boxes (det, frame, x0, y0, x1, y1, class, confidence)."""
    frames = sorted({b[1] for b in boxes}) or [0]
    det = spark.createDataFrame([("c", f, i, a, b, c, d, k, conf, f"saw {i}", "sam", i, "stain" if k == "water" else None) for i, f, a, b, c, d, k, conf in boxes], "capture string, frame int, det int, x0 int, y0 int, x1 int, y1 int, class string, confidence double, evidence string, method string, place int, subtype string")
    px = spark.createDataFrame([("c", f, u, v, depth(u, v)) for f in frames for u in range(64) for v in range(48)], "capture string, frame int, u int, v int, depth double")
    cam = spark.createDataFrame([("c", f, EYE, 32.0, 32.0, 32.0, 24.0) for f in frames], "capture string, frame int, pose array<double>, fx double, fy double, cx double, cy double")
    walls = spark.createDataFrame([("c", "east", 2.0, -2.0, 2.0, 2.0, 0.0, 4.0, 2.5), ("c", "far", 5.0, -2.0, 5.0, 2.0, 0.0, 4.0, 2.5)], "capture string, surface string, x0 double, y0 double, x1 double, y1 double, base double, width double, height double")
    levels = spark.createDataFrame([("c", "floor", 0.0)], "capture string, surface string, z double")
    return det, px, cam, walls, levels


def test_two_views_make_a_region(spark):
    boxes = [(1, 0, 16, 16, 32, 24, "water", 0.9), (2, 1, 16, 16, 32, 24, "water", 0.7), (3, 0, 50, 4, 52, 6, "fire", 0.9), (4, 0, 16, 16, 32, 24, "furniture", 0.9), (5, 1, 0, 0, 64, 48, "mold", 0.2)]
    got = damage.damage_pass(*capture(spark, boxes), ["subtype"], resolution=0.125, area=0.02).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.id, r.damage_class, r.combined, r.subtype, r.frames, r.evidence, r.methods) == ("east#1", "water", None, "stain", [0, 1], ["saw 1", "saw 2"], "sam")
    # 16 x 8 pixels a 16th of a metre apart from u = 1 and a height of 1.2: eight columns, four rows of cells
    assert (r.u0, r.u1, r.v0, r.v1) == (1.0, 2.0, 1.25, 1.75) and r.area == pytest.approx(32 * 0.125**2)


def test_points_of_no_surface_are_left_out(spark):
    boxes = [(1, 0, 0, 0, 64, 48, "water", 0.9)]
    points = damage.project_boxes(*capture(spark, boxes, lambda u, v: 0.0 if u < 8 else 3.3 if u < 32 else 2.05)[:3])
    assert points.count() == 56 * 48
    args = capture(spark, boxes)
    near = damage.assigned_points(points, args[3].drop("width", "height"), args[4])
    by = {r.surface: r["count"] for r in near.groupBy("surface").count().collect()}
    assert set(by) <= {"east", "floor"} and by["east"] > 32 * 30  # what lies behind the wall is on no wall


def test_no_detections(spark):
    det, *rest = capture(spark, [(1, 0, 0, 0, 4, 4, "water", 0.1)])
    assert damage.damage_pass(det, *rest, ["subtype"]).count() == 0


def opening(i, wall, kind, u, state="unmeasured", source="rgb", scene="s"):
    rng = lambda p: None if p is None else {"low": p[0], "high": p[1]}
    return (scene, i, wall, kind, rng(u), rng((0.0, 2.0)), 0.5, [source], state, {"u_sigma_m": 0.01}, [i], 1, 1, source, 0.5, None)


def test_hints_are_compared_with_kept_hints(spark):
    rows = [
        opening(1, 3, "door", (0.0, 1.0)), opening(2, 3, "door", (0.0, 1.0)), opening(3, 3, "door", (5.0, 6.0)), opening(4, 3, "window", (0.0, 1.0)),
        opening(5, None, "door", (0.0, 1.0)), opening(6, None, "door", (0.1, 1.0)), opening(7, None, "door", None), opening(8, None, "door", None),
        opening(9, 4, "door", (0.0, 1.0), "measured", "furniture"), opening(10, 4, "door", (0.1, 1.1)), opening(11, 3, "door", (0.0, 1.0), scene="t"),
    ]
    got = openings.fuse_openings(spark.createDataFrame(rows, "scene string, id int, " + openings.SCHEMA), "scene").collect()
    assert sorted(r.frames[0] for r in got) == [1, 3, 4, 5, 7, 8, 9, 11]
    fused = next(r for r in got if r.wall == 4)
    assert fused.provenance == ["geometry"] and fused.basis == openings.BASIS and fused.sigma == {"u_sigma_m": 0.01, "u_spread_m": 0.0, "v_spread_m": 0.0}
    assert {r.basis for r in got if r.frames != [9]} == {None}
