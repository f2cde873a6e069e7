"""Frame contract, openings, trajectories and grids against results worked out by hand."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.functions import measures, poses, records
from plumbline.operators import evidence, frame_contract, grids, openings, trajectories

EYE = np.eye(4).ravel().tolist()
FRAMES = "capture string, index int, pose array<double>, ts double, approved boolean, dense_error string, dense_reason string, dense_provenance string, has_raw boolean"


def frames(spark):
    flat = np.diag([1.0, 1.0, 0.0, 1.0]).ravel().tolist()
    rows = [
        ("c", 0, EYE, 0.0, True, None, None, None, True),
        ("c", 1, EYE, 0.1, True, "dense QC mask contains no usable pixels", None, None, True),
        ("c", 2, EYE, 0.2, False, None, "blurred", None, True),
        ("c", 3, EYE, 0.3, False, None, "", None, False),
        ("c", 4, EYE, 0.4, None, None, None, None, True),
        ("c", 5, None, None, True, None, None, None, True),
        ("c", 6, flat, 0.6, True, None, None, None, True),
        ("c", 7, EYE[:3] + [float("nan")] + EYE[4:], 0.7, None, None, None, None, True),
        ("c", 8, EYE, 0.8, None, None, None, None, False),
    ]
    return spark.createDataFrame(rows, FRAMES)


def test_frame_decisions(spark):
    auto = {r["index"]: r for r in frame_contract.decide(frames(spark)).collect()}
    assert {i: r.decision for i, r in auto.items()} == {0: "dense", 1: "raw", 2: "raw", 3: "rejected", 4: "raw", 5: "rejected", 6: "rejected", 7: "rejected", 8: "rejected"}
    assert auto[1].fallback == "dense frame rejected (dense QC mask contains no usable pixels); raw LiDAR used"
    assert (auto[2].fallback, auto[3].reason) == ("blurred; raw LiDAR used", "manifest entry is not qc_approved")
    assert auto[5].reason == "pose/timestamp table has no matching frame" and auto[6].reason == "pose rotation/linear part is singular" and auto[7].reason == "pose is not a finite 4x4 transform"
    assert auto[8].reason == "no QC-approved dense depth and no raw LiDAR depth" and (auto[0].source, auto[4].source) == (frame_contract.DENSE, "raw_lidar")
    dense = {r["index"]: (r.decision, r.reason) for r in frame_contract.decide(frames(spark), "dense").collect()}
    assert dense[1] == ("rejected", "dense frame rejected: dense QC mask contains no usable pixels") and dense[4][1] == "dense depth source was requested but no QC-approved entry exists"
    raw = {r["index"]: (r.decision, r.fallback) for r in frame_contract.decide(frames(spark), "raw").collect()}
    assert raw[0] == ("raw", None) and raw[3][0] == "rejected"
    kept = {r["index"]: r.fallback for r in frame_contract.decide(frames(spark), "auto", dense_dir=True).collect()}
    assert kept[4] == "dense raster has no QC-approved manifest entry; raw LiDAR used"
    with pytest.raises(ValueError):
        frame_contract.decide(frames(spark), "other")
    r = frame_contract.contract_report(frame_contract.decide(frames(spark))).first()
    assert (r.selected_frames, r.densified_frames, r.fused_frames, r.fused_dense_frames, r.rejected_frames, r.dense_qc_rejected_frames, r.fallback_frames, r.rejected_frames_total) == (9, 6, 4, 1, 5, 2, 2, 7)
    assert r.integrated_indices == [0, 1, 2, 4] and [x["index"] for x in r.rejections] == [3, 5, 6, 7, 8]


def test_pixels_and_strides(spark):
    df = spark.createDataFrame([(1500, 2, 1), (0, 2, 1), (9000, 2, 1), (1500, 0, 1), (1500, None, 0)], "d int, c int, m int")
    p = df.select(frame_contract.raw_pixel(F.col("d"), F.col("c")).alias("r"), frame_contract.dense_pixel(F.col("d") / 1000.0, F.col("c"), F.col("m")).alias("q"))
    got = p.select("r.depth", "r.qc", frame_contract.valid_pixel(F.col("r")).alias("ok"), F.col("q.qc").alias("dq")).collect()
    assert [tuple(r) for r in got] == [(1.5, True, True, True), (0.0, False, False, False), (0.0, False, False, False), (0.0, True, False, False), (1.5, True, True, False)]
    x = spark.createDataFrame([("a", i) for i in (3, 1, 7, 5, 1, -2)], "k string, i int")
    assert [r.i for r in frame_contract.frame_indices(x, "i").collect()] == [1, 3, 5, 7]
    assert sorted(r.i for r in frame_contract.strided(x.distinct(), "k", "i", 2).collect()) == [-2, 3, 7]
    with pytest.raises(ValueError):
        frame_contract.strided(x, "k", "i", 0)
    gate = spark.createDataFrame([(1, True, 0.1), (1, False, 9.0), (2, True, 0.5), (3, False, 0.0)], "f int, ok boolean, e double")
    assert {r.f: r.approved for r in frame_contract.densify_gate(gate, ["f"], F.col("ok"), F.col("e")).collect()} == {1: True, 2: False, 3: False}
    late = frame_contract.missing_frames(x.select("k", "i").distinct(), x.where("i > 1"), ["k", "i"])
    assert sorted(r.i for r in late.collect()) == [-2, 1]


def opening(wall, kind, u, v, conf, state="measured", source="geometry", i=0):
    rng = lambda r: {"low": r[0], "high": r[1]} if r else None
    return ("s", i, wall, kind, rng(u), rng(v), conf, [source], state, {"u_sigma_m": 0.01}, [i], 1, 10, source, 0.9, 0.1)


def test_openings_are_fused(spark):
    schema = "scene string, id int, " + openings.SCHEMA
    rows = [
        opening(3, "door", (0.4, 1.2), (0.0, 2.1), 0.75, i=1),
        opening(3, "door", (0.5, 1.3), (0.0, 2.0), 0.5, source="rgb", i=2),
        opening(3, "door", (2.5, 3.3), (0.0, 2.0), 0.6, i=3),
        opening(3, "door", (0.6, 1.2), None, 0.4, state="unmeasured", source="roomformer", i=4),
        opening(None, "window", (0.6, 1.2), (1.0, 2.0), 0.4, source="roomformer", i=5),
        opening(3, "window", (0.4, 1.2), (0.0, 2.1), 0.8, i=6),
    ]
    got = openings.fuse_openings(spark.createDataFrame(rows, schema), "scene").collect()
    assert sorted((r.wall or -1, r.kind, r.state, r["count"]) for r in got) == [(-1, "window", "measured", 1), (3, "door", "measured", 1), (3, "door", "measured", 2), (3, "window", "measured", 1)]
    two = next(r for r in got if r["count"] == 2)
    assert two.u.low == pytest.approx((0.75 * 0.4 + 0.5 * 0.5) / 1.25) and two.confidence == pytest.approx(1 - 0.25 * 0.5)
    assert two.provenance == ["geometry", "rgb", "fused"] and two.method == "fused" and two.support == 20 and two.sigma["u_spread_m"] == pytest.approx(0.05)


def test_predictions_become_openings(spark):
    docs = [
        json.dumps({"openings": [{"label": "Doorway", "score": 0.9, "wall": "north", "u_range": [1.2, 0.4], "v": 0, "v_min": 0.0, "height_m": 2.0}, {"label": "sofa", "score": 1}, {"kind": "window", "confidence": 0.1}]}),
        json.dumps({"labels": ["window"], "boxes": [[0.25, 0.5, 0.75, 1.0]]}),
        json.dumps([5, {"kind": "arch", "score": "0.8", "wall_index": "2", "frame": [4, 5]}]),
    ]
    df = spark.createDataFrame(list(enumerate(docs)), "doc int, text string")
    walls = spark.createDataFrame([("north", 7)], "name string, wall int")
    got = {(r.doc, r.place): r for r in openings.adapt_predictions(df, "text", walls, 0.2, 100, 200).collect()}
    a = got[0, 0].opening
    assert (a.wall, a.kind, a.u.low, a.u.high, a.v.high, a.state, a.wall_confidence) == (7, "door", 0.4, 1.2, 2.0, "measured", 1.0)
    assert got[0, 1].rejection == "unknown/furniture label" and got[0, 2].rejection == "confidence below threshold" and got[2, 0].rejection == "prediction is not an object"
    assert got[1, 0].opening.box == [50.0, 50.0, 150.0, 100.0] and got[1, 0].opening.state == "unmeasured"
    assert (got[2, 1].opening.wall, got[2, 1].opening.frames, got[2, 1].opening.confidence) == (2, [4, 5], 0.8)


def test_clocks_and_alignment(spark):
    t = spark.createDataFrame([("a", 10.0 + i) for i in range(5)], "k string, ts double")
    p = spark.createDataFrame([("a", 100.0 + i) for i in range(5)] + [("a", 100.02)], "k string, ts double")
    got = trajectories.clock_matches(t, p, "k", 0.05).orderBy("ts").collect()
    assert [(r.ts, r.prior_ts) for r in got] == [(10.0 + i, 100.0 + i) for i in range(5)] and {r.offset for r in got} == {90.0}
    rng = np.random.default_rng(2)
    src = rng.standard_normal((30, 3))
    c, s = np.cos(0.3), np.sin(0.3)
    rot = np.array([[c, -s, 0], [s, c, 0], [0, 0, 1]])
    dst = 1.25 * src @ rot.T + [1, 2, 3]
    dst[0] += 5  # dropped by the robust pass
    rows = [("a", *map(float, a), *map(float, b)) for a, b in zip(src, dst)] + [("b", 0.0, 0.0, 0.0, 1.0, 1.0, 1.0)]
    fit = {r.k: r for r in trajectories.align(spark.createDataFrame(rows, "k string, sx double, sy double, sz double, tx double, ty double, tz double"), "k").collect()}
    assert fit["a"].mode == "sim3" and fit["a"].scale == pytest.approx(1.25) and fit["a"].inliers == 29 and fit["a"].failures == []
    assert fit["b"].failures == ["too few matched places"]


def test_resampling_and_propagation(spark):
    half = float(np.sqrt(0.5))
    samples = spark.createDataFrame([("a", 0.0, [0.0, 0.0, 0.0, 1.0], [0.0, 0.0, 0.0]), ("a", 1.0, [0.0, 0.0, half, half], [2.0, 0.0, 0.0]), ("a", 5.0, [0.0, 0.0, half, half], [2.0, 0.0, 0.0])], "k string, ts double, quaternion array<double>, place array<double>")
    at = lambda *t: trajectories.resample_poses(spark.createDataFrame([("a", x) for x in t], "k string, ts double"), samples, "k").orderBy("ts").collect()
    got = at(0.5, 1.0)
    assert got[0].place == [1.0, 0.0, 0.0] and got[0].quaternion == pytest.approx([0, 0, np.sin(np.pi / 8), np.cos(np.pi / 8)]) and got[1].place == [2.0, 0.0, 0.0]
    for bad, word in ((3.0, "in a step"), (9.0, "outside")):
        with pytest.raises(Exception, match=word):
            at(bad)
    moved = [*EYE]
    moved[3] = 2.0
    f = spark.createDataFrame([("a", i, EYE) for i in range(6)], "k string, index int, pose array<double>")
    k = spark.createDataFrame([("a", 1, EYE), ("a", 3, moved)], "k string, index int, refined array<double>")
    assert [r.pose[3] for r in trajectories.propagate(f, k, "k").orderBy("index").collect()] == pytest.approx([0, 0, 1, 2, 2, 2])


def test_openings_in_a_wall(spark):
    cells = []
    for u in range(60):
        for v in range(60):
            door = 10 <= u < 26 and v < 45
            window = 36 <= u < 52 and 20 <= v < 38
            if not door and not window:
                cells.append((1, u, v, 5, 0))
            elif window and u < 37:
                cells.append((1, u, v, 0, 0))
    cells += [(2, u, 0, 1, 0) for u in range(10)]
    df = spark.createDataFrame(cells, "wall int, cu long, cv long, hits long, near long")
    size = spark.createDataFrame([(1, 60, 60), (2, 60, 60)], "wall int, columns int, rows int")
    got = {r.kind: r for r in grids.find_openings(df, ["wall"], size).collect()}
    assert set(got) <= {"window", "door", "pass-through"} and got["window"].wall == 1
    w = got["window"]
    assert (round(w.u0 / 0.04), round(w.u1 / 0.04), round(w.v0 / 0.04), round(w.v1 / 0.04)) == (37, 51, 21, 37) and w.confidence == 1.0
    hidden = df.unionByName(spark.createDataFrame([(1, u, v, 0, 5) for u in range(36, 52) for v in range(20, 38)], df.schema))
    assert "window" not in {r.kind for r in grids.find_openings(hidden.groupBy("wall", "cu", "cv").agg(F.max("hits").alias("hits"), F.max("near").alias("near")), ["wall"], size).collect()}


def test_plan_grid_and_peaks(spark):
    pts = spark.createDataFrame([(0.0, 0.0, 0.0), (0.01, 0.0, 1.0), (1.0, 1.0, 0.05), (1.0, 1.0, 5.0), (float("nan"), 0.0, 0.0)], "u double, v double, h double")
    got = {(r.cu, r.cv): (r.occupied, r.free) for r in grids.plan_grid(pts, 0.0, path=spark.createDataFrame([(0.0, 0.0), (0.0, 0.0), (9.0, 9.0)], "u double, v double")).collect()}
    assert sum(o for o, _ in got.values()) == 1 and sum(f for _, f in got.values()) == 2 + 3
    flat = spark.createDataFrame([(float(b),) for b, n in ((0, 6), (1, 8), (2, 8), (3, 5), (5, 7)) for _ in range(n)], "x double")
    assert sorted(r.bin for r in grids.peaks(flat, F.col("x"), 1.0).collect()) == [1, 2, 5]  # a plateau counts on either side
    near = spark.createDataFrame([(1, u, v, 0, 3) for u in (2, 3, 4, 5, 6, 7, 8) for v in range(4)] + [(1, 20, 0, 0, 3)], "s int, cu long, cv long, hits long, near long")
    assert [(r.low, r.high) for r in grids.hidden_spans(near, "s", F.lit(30), F.lit(10), 0.04).collect()] == [(pytest.approx(0.08), pytest.approx(0.36))]


def test_robust_location_and_consensus(spark):
    v = [1.0, 1.01, 0.99, 1.02, 0.98, 1.3, 5.0]
    r = evidence.robust_location(spark.createDataFrame([("k", x) for x in v], "k string, v double"), "k", "v", 0.08).first()
    assert r.location == pytest.approx(1.0) and r.n == 5
    det = spark.createDataFrame([(1, "water", 1.0, 0.5, 3, "", 0, "a", None), (1, "water", 2.0, 0.5, 1, "wet", 1, "b", 2), (1, "fire", 1.0, 0.8, 2, "burnt", 2, None, None)], "region int, cls string, weight double, confidence double, frame int, evidence string, place int, subtype string, category int")
    votes = evidence.consensus(det, "region", "cls", ["subtype", "category"])
    got = {r.cls: r for r in votes.collect()}
    assert (got["water"].subtype, got["water"].category, got["water"].frames, got["water"].evidence) == ("b", 2, [1, 3], ["wet"])
    both = evidence.combined_consensus(votes, spark.createDataFrame([(1, "fire", "water")], "region int, top string, second string"), "region", "cls", ["subtype", "category"]).first()
    assert (both.subtype, both.category, both.confidence, both.frames, both.evidence) == ("b", 2, pytest.approx(0.65), [1, 2, 3], ["burnt", "wet"])
    up = evidence.refined_up(spark.createDataFrame([("k", 0.0, 0.1, -2.0)] * 120 + [("j", 0.0, 0.0, 1.0)], "k string, x double, y double, z double"), "k", ["x", "y", "z"], [0.0, 0.0, 1.0])
    ups = {r.k: r.up for r in up.collect()}
    assert ups["j"] == [0.0, 0.0, 1.0] and ups["k"] == pytest.approx(list(np.array([0, -0.1, 2.0]) / np.hypot(0.1, 2.0)))


def test_measures_stay_in_range(spark):
    row = spark.range(1).select(
        measures.evidence_confidence(F.lit(0), F.lit(-1.0), F.lit(0.0)).alias("low"), measures.evidence_confidence(F.lit(50), F.lit(9.0), F.lit(3.0)).alias("high"),
        measures.height_half_width(F.lit(0.01), F.lit(1), F.lit(0.01), F.lit(1), False, 2.0).alias("h"), measures.area_half_width(F.lit(10.0), F.lit(0.01), True, 1.5).alias("a"),
        records.opening_kind(F.lit(" Door_way. ")).alias("none"), records.opening_kind(F.lit("Pass_Through;")).alias("pass"), poses.slerp_any(F.array(*[F.lit(x) for x in (0.0, 0.0, 0.0, 2.0)]), F.array(*[F.lit(x) for x in (0.0, 0.0, 0.0, -3.0)]), F.lit(0.5)).alias("q"),
    ).first()
    assert (row.low, row.high) == (0.0, 1.0) and row.h == pytest.approx(1.645 * np.hypot(0.01, 0.01) * 6) and row.a == pytest.approx(10 * 0.01 / 2 * 1.645 * 1.5)
    assert (row.none, row["pass"]) == (None, "pass-through") and row.q == pytest.approx([0, 0, 0, 1])


def test_appended_visits(spark, tmp_path):
    from plumbline.streaming.visits import write_visits

    rows = [(1, "2024-01-01 00:00:00", 1.0), (1, "2024-01-01 00:05:00", 2.0), (1, "2024-01-01 06:00:00", 4.0), (2, "2024-02-01 00:00:00", 8.0)]
    late = [(1, "2024-01-01 00:06:00", 99.0), (3, "2024-03-01 00:00:00", 1.0)]
    schema = "user_id long, ts timestamp_ntz, value double"
    frame = lambda r: spark.createDataFrame(r, "user_id long, ts string, value double").selectExpr("user_id", "cast(ts as timestamp_ntz) as ts", "value")
    for part in (rows, late):
        frame(part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        events = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        write_visits(events, 3600.0, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got = sorted((r.track, r.n, r.total) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert (1, 2, 3.0) in got and (1, 1, 4.0) in got and not any(t == 99.0 or n == 3 for _, n, t in got)  # the late row is dropped
