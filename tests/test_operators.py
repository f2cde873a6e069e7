"""Small facts with known answers, and operators without SQL against plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.functions import binning, geometry, measures
from plumbline.operators import asof, evidence, fits, folds, graphs, grids, joins, scope, scoring, sessions
from plumbline.sources import sinks


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


def test_bins(spark):
    x = F.lit(-1.7)
    assert one(spark, binning.trunc_clip(x, 1.0, 5), binning.trunc(x, 1.0), binning.half_even(F.lit(2.5), 1.0), binning.half_even(F.lit(3.5), 1.0)) == (0, -1, 2, 4)
    assert one(spark, binning.floor_drop(x, 1.0, 5), binning.floor_drop(F.lit(4.9), 1.0, 5), binning.rint_clip(F.lit(9.0), F.lit(0.0), F.lit(4.0), 8)) == (None, 4, 7)


def test_geometry(spark):
    square = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((0.0, 0.0), (4.0, 0.0), (4.0, 3.0), (0.0, 3.0))])
    assert one(spark, geometry.signed_area(square), geometry.point_in_polygon(F.lit(1.0), F.lit(1.0), square), geometry.point_in_polygon(F.lit(5.0), F.lit(1.0), square)) == (12.0, True, False)
    assert one(spark, geometry.quaternion_matrix(*[F.lit(0.0)] * 4)) == ([1.0, 0, 0, 0, 1.0, 0, 0, 0, 1.0],)
    half = geometry.quaternion_matrix(F.lit(0.0), F.lit(0.0), F.lit(2.0), F.lit(2.0))
    eye = F.array(*[F.lit(float(i % 4 == 0)) for i in range(9)])
    assert one(spark, geometry.rotation_degrees(half, eye))[0] == pytest.approx(90)
    assert one(spark, geometry.compass(F.lit(0.0), F.lit(-1.0)), geometry.compass(F.lit(-1.0), F.lit(0.01))) == ("south", "west")
    assert one(spark, geometry.overlap((F.lit(0.0), F.lit(2.0)), (F.lit(1.0), F.lit(4.0))))[0] == 0.25


def test_nearest_ties_and_tolerance(spark):
    left = spark.createDataFrame([(1, 15.0, 1), (1, 40.0, 2), (2, 0.0, 3)], "k int, t double, id int")
    right = spark.createDataFrame([(1, 10.0, 7, 0.1), (1, 20.0, 8, 0.2)], "k int, t double, id int, v double")
    pick = lambda **kw: {r.id: r.match_id for r in asof.nearest(left, right, "k", "t", "id", "v", **kw).collect()}
    assert pick() == {1: 7, 2: 8} and pick(ties="later") == {1: 8, 2: 8} and pick(tolerance=5.0) == {1: 7}


def test_resample(spark):
    target = spark.createDataFrame([(1, t, i) for i, t in enumerate((0.0, 0.25, 0.5, 0.75, 1.0, 1.5))], "k int, t double, id int")
    samples = spark.createDataFrame([(1, 0.0, 0, 0.0), (1, 1.0, 1, 2.0)], "k int, t double, id int, x double")
    assert [r.value for r in asof.resample(target, samples, "k", "t", "id", "x", 1.0).orderBy("id").collect()] == [0.0, 0.5, 1.0, 1.5, 2.0]
    assert asof.resample(target, samples, "k", "t", "id", "x", 0.5).count() == 2


def test_association_is_monotone(spark):
    f = spark.createDataFrame([(1, float(t), i) for i, t in enumerate((0, 1, 1.1, 5))], "k int, t double, id long")
    m = spark.createDataFrame([(1, float(t) + 100, i + 10) for i, t in enumerate((0, 1, 2))], "k int, t double, id long")
    got = {r.frame_id: r.mark_id for r in folds.associate(f, m, "k", "t", "id", 0.5).collect()}
    assert got == {0: 10, 1: 11, 2: None, 3: None}


def test_fusion_groups_by_head_only(spark):
    rows = [(1, 0, 0.0, 1.0, 0.9), (1, 1, 0.3, 1.3, 0.8), (1, 2, 0.6, 1.6, 0.7), (1, 3, 5.0, 6.0, 0.5)]
    df = spark.createDataFrame(rows, "k int, id long, lo double, hi double, c double")
    got = folds.fuse_intervals(df, "k", "lo", "hi", "c", "id", centre=0.35, share=0.5).orderBy("head").collect()
    assert [(r.head, r.n) for r in got] == [(0, 2), (2, 1), (3, 1)]
    assert got[0].confidence == pytest.approx(1 - 0.1 * 0.2) and got[0].low == pytest.approx(0.3 * 0.8 / 1.7)


def test_visits_ignore_row_order(spark):
    rng = random.Random(1)
    rows = [(k, rng.choice([0, 1, 2, 50, 51]) + rng.random(), rng.random(), i) for i, k in enumerate([1, 2, 3] * 40)]
    df = spark.createDataFrame(rows, "k int, t double, v double, id int")
    a, b = (sorted(map(tuple, sessions.drift(x, "k", "t", "v", 10.0, 3, "id").collect())) for x in (df, df.orderBy(F.rand(3)).repartition(5)))
    assert a == b and [r[1] for r in a] == [2, 2, 2]


def test_components_of_a_long_path(spark):
    n = spark.range(300)
    e = spark.range(299).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.label for r in graphs.components(n, e).collect()} == {0}


def test_morphology(spark):
    ring = spark.createDataFrame([(u, v) for u in range(5) for v in range(5) if (u, v) != (2, 2)], "cu long, cv long")
    closed = {tuple(r) for r in grids.close(ring, []).collect()}
    assert (2, 2) in closed and len(closed) == 25
    assert grids.opened(spark.createDataFrame([(0, 0)], "cu long, cv long"), []).count() == 0
    diagonal = spark.createDataFrame([(0, 0), (1, 1), (5, 5)], "cu long, cv long")
    assert grids.label_cells(diagonal, 100).select("label").distinct().count() == 3
    assert grids.label_cells(diagonal, 100, True).select("label").distinct().count() == 2


def test_near_pairs_match_all_pairs(spark):
    rng = np.random.default_rng(0)
    p = rng.uniform(-1, 1, (120, 3))
    df = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(p)], "id int, x double, y double, z double")
    want = {(i, j) for j in range(120) for i in range(j) if np.linalg.norm(p[i] - p[j]) < 0.3}
    assert {(r.i, r.j) for r in joins.near_pairs(df, "id", ["x", "y", "z"], 0.3).collect()} == want


def test_thickness_of_opposing_faces(spark):
    df = spark.createDataFrame([(1, "g", 0.0, 0.0, 4.0), (2, "g", 0.2, 0.0, 4.0), (3, "g", 0.21, 3.9, 4.1)], "id int, g string, o double, lo double, hi double")
    got = {r.id: (r.other, round(r.separation, 6)) for r in joins.opposing(df, "id", "g", "o", ("lo", "hi"), 0.025, 0.8, 0.25).collect()}
    assert got == {1: (2, 0.2), 2: (1, 0.2)}


def test_fits(spark):
    rng = np.random.default_rng(3)
    x = rng.uniform(1, 5, 150)
    y = 2 * x + 0.5
    y[:40] += 3
    df = spark.createDataFrame([("a", float(a), float(b)) for a, b in zip(x, y)] + [("b", 1.0, 1.0)], "k string, x double, y double")
    got = {r.k: r for r in fits.scale_shift(df, "k", "x", "y").collect()}
    assert got["a"].scale == pytest.approx(2, abs=0.05) and got["a"]["shift"] == pytest.approx(0.5, abs=0.2) and got["b"].scale is None
    pts = spark.createDataFrame([(1, float(a), float(b), 0.5) for a, b in rng.uniform(0, 1, (50, 2))], "k int, x double, y double, z double")
    plane = fits.tls_planes(pts, "k").first()
    assert (round(abs(plane.nz), 6), round(plane.offset, 6), round(plane.rms, 6)) == (1.0, 0.5, 0.0)
    src = rng.standard_normal((20, 3))
    c, s = np.cos(0.3), np.sin(0.3)
    rot = np.array([[c, -s, 0], [s, c, 0], [0, 0, 1]])
    scale, r, t = fits.similarity(src, 1.25 * src @ rot.T + [1, 2, 3], True)
    assert scale == pytest.approx(1.25) and np.allclose(r, rot) and np.allclose(t, [1, 2, 3])


REGION = "id long, room_id long, surface_key string, surface_kind string, damage_class string, combined_classes array<string>, area double, v0 double, v1 double, width double, height_extent double, water_category int, water_class int, mold_condition int, subtype string, run_length double"
ROOM = "room_id long, room_name string, room_area double, room_height double, perimeter double"


def regions_and_rooms(spark):
    rows = [
        (1, 1, "room1-floor", "floor", "water", None, 2.0, 0.0, 0.0, 1.0, 1.0, 3, None, None, None, None),
        (2, 1, "wall-2", "wall", "water", None, 2.0, 0.0, 0.4, 2.0, 0.4, 2, 3, None, None, 1.5),
        (3, 1, "wall-3", "wall", "mold", None, 1.2, 0.0, 1.0, 1.0, 1.0, None, None, 3, None, 4.0),
        (4, 2, "wall-4", "wall", "fire", None, 0.4, 0.0, 1.0, 1.0, 1.0, None, None, None, "char", 4.0),
        (5, 2, "wall-5", "wall", "combined", ["water", "fire"], 0.4, 0.0, 1.0, 1.0, 1.0, 2, 3, 3, "soot", 4.0),
        (6, 3, "wall-6", "wall", "mold", None, 0.3, 0.0, 1.0, 1.0, 0.5, None, None, 1, None, 4.0),
        (7, 9, "ceiling-7", "ceiling", "water", None, 3.0, 0.0, 1.0, 1.0, 1.0, 2, None, None, None, None),
    ]
    rooms = [(1, "Kitchen", 10.0, None, 13.0), (2, "Hall", 5.0, 2.5, 9.0), (3, "Bath", 4.0, 2.4, 8.0)]
    return spark.createDataFrame(rows, REGION), spark.createDataFrame(rooms, ROOM)


def test_scope_rules(spark):
    r, room = regions_and_rooms(spark)
    water = {(x.id, x.code): x.quantity for x in scope.water_items(r).collect()}
    assert set(c for i, c in water if i == 1) == {"carpet_remove", "pad_remove"}  # no antimicrobial on floors
    assert water[2, "drywall_remove"] == pytest.approx(1.22 * 1.5) and water[2, "baseboard_replace"] == 1.5
    assert water[5, "drywall_remove"] == pytest.approx(2.44) and water[7, "drywall_remove"] == 3.0 and (7, "baseboard_replace") not in water
    dry = {(x.room_id, x.code): x.quantity for x in scope.drying_items(r, room).collect()}
    assert dry == {(1, "air_mover"): 4.0, (1, "dehumidifier"): 8.0, (1, "monitoring_visit"): 4.0, (2, "air_mover"): 4.0, (2, "dehumidifier"): 4.0, (2, "monitoring_visit"): 4.0}
    mold = {(x.id, x.code): x.quantity for x in scope.mold_items(r).collect()}
    assert mold[6, "hepa_vacuum"] == pytest.approx(1.6 * 1.1 * 2) and (6, "mold_remove") not in mold  # condition 1 is vacuumed
    assert {x.code: x.quantity for x in scope.containment_items(r, room).collect()} == {"containment_barrier": 13 * 2.4 + 10, "negative_air": 3.0, "ppe_set": 6.0}
    assert {(x.id, x.code) for x in scope.fire_items(r).collect()} == {(4, "char_remove"), (5, "soot_clean"), (5, "seal_surface")}
    assert [(x.room_id, x.derived_from) for x in scope.odour_items(r, room).collect()] == [(2, [4, 5])]
    assert {(x.id, x.rule_id) for x in scope.concealed_flags(r).collect()} == {(1, "W-02"), (2, "W-01"), (2, "W-03"), (2, "W-04"), (3, "M-01"), (3, "M-02"), (4, "F-01"), (4, "F-02"), (6, "M-02")}
    assert one(spark, scope.flood_cut(F.lit(0.0)), scope.flood_cut(F.lit(0.92)), scope.flood_cut(F.lit(9.0))) == (0.61, 1.22, 2.44)
    plain = scope.override("water.flood_cut.snap_to_standard", False)
    assert one(spark, scope.flood_cut(F.lit(0.9), plain)) == (pytest.approx(1.2),)


def test_scope_build(spark):
    r, room = regions_and_rooms(spark)
    items = scope.scope_build(r, room).collect()
    assert len(items) == 2 + 5 + 3 + 1 + 5 + 2 + 1 + 4 + 3 + 3 + 3 + 1  # regions 1, 2, 3, 4, 5 (water, fire), 6, 7, then rooms
    by = {(x.surface_ref, x.code): x for x in items}
    cut = by["wall-2", "drywall_remove"]
    assert (cut.description, cut.unit, cut.trade, cut.material, cut.derived_from) == ("Remove drywall, cut to height", "m2", "drywall", "drywall", [2])
    assert cut.basis == "waterline 0.40 m + 0.30 m margin = 0.70 m, snapped up to the 1.22 m sheet line; cut 1.22 m x 1.50 m affected run"
    assert by["Kitchen", "air_mover"].basis == "1 units x 4 days; 2.0 m2 wet floor + 2.0 m2 wet wall, Class 3"
    assert by["Kitchen", "ppe_set"].material == "half_face_respirator_suit"
    assert by["Hall", "odour_treatment"].basis == "0.80 m2 of fire damage exceeds the 0.50 m2 deodorisation trigger"
    assert by["ceiling-7", "drywall_replace"].room_id == 9 and not any(x.surface_ref is None for x in items)
    sweep = {(x.margin, x.snapped): x.area for x in scope.margin_sweep(r, [0.3]).collect()}
    assert sweep[0.3, True] == pytest.approx(1.22 * 1.5 + 2.44 + 3.0) and sweep[0.3, False] == pytest.approx(0.7 * 1.5 + 1.3 + 3.0)


def test_rules_from_a_file(spark, tmp_path):
    import yaml

    path = tmp_path / "rules.yaml"
    path.write_text(yaml.safe_dump(scope.override("mold.hepa_vacuum_passes", 3)))
    r, _ = regions_and_rooms(spark)
    got = {x.id: x.quantity for x in scope.mold_items(r, scope.load_rules(path)).where("code = 'hepa_vacuum'").collect()}
    assert got[6] == pytest.approx(1.6 * 1.1 * 3)
    path.write_text("water: {}")
    with pytest.raises(ValueError, match="no part"):
        scope.load_rules(path)


def test_scores(spark):
    boxes = [F.lit(x) for x in (0.0, 2.0, 0.0, 2.0)], [F.lit(x) for x in (1.0, 3.0, 0.0, 2.0)]
    assert one(spark, scoring.box_iou(*boxes))[0] == pytest.approx(1 / 3)
    assert one(spark, scoring.box_iou(boxes[0], [F.lit(None).cast("double")] * 4))[0] == 0.0
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b")], "t string, f string")
    r = scoring.macro_f1(df, "t", "f").first()
    assert r.n_classes == 2 and r.macro_f1 == pytest.approx(2 / 3)
    none = spark.createDataFrame([], "k int")
    assert scoring.set_scores(none, none, ["k"]).first()["precision"] is None


def test_consensus(spark):
    df = spark.createDataFrame([(1, "x", 1.0, 0), (1, "y", 2.0, 1), (1, None, 9.0, 2), (2, "b", 1.0, 5), (2, "a", 1.0, 4)], "k int, v string, w double, o int")
    assert {r.k: r["mode"] for r in evidence.weighted_mode(df, "k", "v", F.col("w"), "o").collect()} == {1: "y", 2: "a"}
    dom = evidence.dominant_class(df.where("v is not null"), "k", "v", F.col("w")).collect()
    assert {r.k: r.dominant for r in dom} == {1: "combined", 2: "combined"}
    sure = evidence.noisy_or(spark.createDataFrame([(1, 1.0, 0.5), (1, 3.0, 1.0)], "k int, x double, c double"), "k", F.col("x"), F.col("c")).first()
    assert sure.confidence == 1.0


def test_measures_and_sinks(spark, tmp_path):
    assert one(spark, measures.plane_sigma(F.lit(0.01), F.lit(400)))[0] == pytest.approx(0.002)
    assert one(spark, measures.flags((F.lit(True), "b"), (F.lit(True), "a"), (F.lit(False), "c"), (F.lit(True), "a")))[0] == ["a", "b"]
    assert one(spark, sinks.measured(F.lit(None).cast("double")), sinks.measured(F.lit(1.23456))) == ("", "1.235")
    df = spark.createDataFrame([(1, ["rgb", "fused"]), (None, [])], "id int, provenance array<string>")
    assert [r.provenance for r in sinks.openings_rows(df).collect()] == ["rgb+fused", ""]
    bad = sinks.conformance(df, ("id: required", F.col("id").isNotNull()), ("ok", F.lit(True))).collect()
    assert [tuple(r) for r in bad] == [("id: required", 1)]
    sinks.write_csv(sinks.openings_rows(df), str(tmp_path / "c"))
    assert spark.read.csv(str(tmp_path / "c"), header=True).count() == 2


def test_scope_delta_reaches_every_room(spark):
    from plumbline.plans import rules
    from plumbline.sources.tables import regions

    data = "/root/testdata/sf0.001"
    mold = {r.room_id for r in regions(spark, data).where("damage_class = 'mold' or array_contains(combined_classes, 'mold')").collect()}
    assert {r.room_id for r in rules.QUERIES["scope_delta_all"](spark, data).collect()} == mold


def test_every_point_of_another_label_blocks(spark):
    rng = np.random.default_rng(4)
    rows = [(i + 1 + i // 6, i % 3, *map(float, p)) for i, p in enumerate(rng.uniform(-0.5, 0.5, (240, 2)))]  # no id is divisible by 7
    assert all(r[0] % 7 for r in rows)
    df = spark.createDataFrame(rows, "id long, label int, x double, y double")
    got = {r.label: (r.n, round(r.blocked, 9)) for r in joins.blocked_near(df, "label", ("x", "y"), 0.05, "id", 0.33, 20).collect()}
    hit = {i: any(w != l and abs(x - a) < 0.05 and abs(y - b) < 0.05 for _, w, a, b in rows) for i, l, x, y in rows}
    want = {l: (80, round(sum(hit[r[0]] for r in rows if r[1] == l) / 80, 9)) for l in range(3)}
    assert got == {l: w for l, w in want.items() if w[1] >= 0.33} and got


def test_best_pair_line_finds_a_line_off_the_mean(spark):
    t = np.linspace(0, 4, 120)
    pts = [(float(a), 0.5 * a) for a in t] + [(float(a), 0.5 * a + 3) for a in t[::2]]
    df = spark.createDataFrame([(i, 1, x, float(y)) for i, (x, y) in enumerate(pts)] + [(999, 2, 0.0, 0.0), (1000, 2, 0.1, 0.0)], "id long, k int, x double, y double")
    got = fits.best_pair_line(df, "k", "id", "x", "y", 0.05).collect()
    assert [(r.k, r.inliers) for r in got] == [(1, 120)]  # key 2 has no two points far enough apart
    assert abs(np.tan(got[0].angle) - 0.5) < 1e-6 and abs(got[0].offset) < 1e-6
    fixed = spark.range(36).select(F.col("id").alias("line"), (F.col("id") * np.pi / 36).alias("angle"))
    assert fits.best_line(df, "k", "x", "y", fixed, 0.05).where("k = 1").first().inliers < 120


def test_shift_is_the_median_rest_at_every_size(spark):
    rng = np.random.default_rng(6)
    rows = []
    for k, n in ((1, 300), (2, 2100)):
        x = rng.uniform(1, 5, n)
        y = 2 * x + 0.5 + rng.standard_normal(n) * rng.choice([0.1, 2.0], n) + (x > 4) * 1.5
        rows += [(k, float(a), float(b)) for a, b in zip(x, y)]
    for r in fits.scale_shift(spark.createDataFrame(rows, "k int, x double, y double"), "k", "x", "y").collect():
        assert r["shift"] == pytest.approx(np.median([b - r.scale * a for k, a, b in rows if k == r.k]), abs=1e-9)
