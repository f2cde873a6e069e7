"""Readers of capture files against rows worked out by hand."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.sources import captures

EYE = [1.0, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1]


def test_odometry_and_imu(spark, tmp_path):
    head = "timestamp, frame, x, y, z, qx, qy, qz, qw, fx, fy, cx, cy\n"
    (tmp_path / "odometry.csv").write_text(head + "100.0, 0, 0.0, 0, 0, 0, 0, 0, 1, 500, 510, 320, 240\n, 1, 9, 9, 9, 0, 0, 0, 1, 1, 1, 1, 1\n100.5, 2, 1.0, 0, 0, 0, 0, 0, 2, 502, 512, 322, 242\n")
    rows = captures.read_odometry(spark, str(tmp_path / "odometry.csv")).orderBy("ts").collect()
    assert [(r.ts, r.pose[3], r.fx) for r in rows] == [(100.0, 0.0, 500.0), (100.5, 1.0, 502.0)]
    assert rows[0].pose == EYE and rows[1].pose[0] == 1.0
    (tmp_path / "imu.csv").write_text("timestamp,a_x,a_y,a_z\n" + "".join(f"{100 + i / 100},-1,0,0\n" for i in range(20)) + "\n")
    poses = captures.pose_priors(spark, str(tmp_path / "odometry.csv")).withColumn("capture", F.lit("c"))
    imu = captures.read_imu(spark, str(tmp_path / "imu.csv")).withColumn("capture", F.lit("c"))
    got = captures.gravity(poses, imu).first()
    assert got.up == pytest.approx([0.0, 1.0, 0.0]) and got.consistency == pytest.approx(1.0)
    none = captures.gravity(poses, imu.limit(0)).first()
    assert none.up == [0.0, 1.0, 0.0] and none.consistency == 0.0
    one = captures.capture_bundle(captures.read_odometry(spark, str(tmp_path / "odometry.csv")), (640, 480), (320, 240)).first()
    assert (one.n, one.fps, one.fx, one.cy) == (2, 2.0, 250.5, 120.5)
    (tmp_path / "odometry.csv").write_text(head + "1.0, 0, nan, 0, 0, 0, 0, 0, 1, 500, 510, 320, 240\n")
    with pytest.raises(Exception, match="not finite"):
        captures.read_odometry(spark, str(tmp_path / "odometry.csv")).collect()


def test_pose_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Frame, tx, y, z, qx, qy, qz, w, time\n2, 5, 0, 0, 0, 0, 0, 1, \n1, 4, 0, 0, 0, 0, 0, 1, 7.5\n")
    got = captures.read_poses(spark, str(tmp_path / "a.csv"), 10.0).orderBy("frame").collect()
    assert [(r.frame, r.ts, r.pose[3]) for r in got] == [(0, 7.5, 4.0), (1, 0.1, 5.0)]
    cells = [f"m{r}{c}" for r in range(4) for c in range(4)]
    (tmp_path / "b.csv").write_text(",".join(cells) + "\n" + ",".join(map(str, EYE)) + "\n")
    assert captures.read_poses(spark, str(tmp_path / "b.csv"), 10.0).first().pose == EYE
    (tmp_path / "c.csv").write_text("x,y\n1,2\n")
    with pytest.raises(Exception, match="neither a matrix"):
        captures.read_poses(spark, str(tmp_path / "c.csv"), 10.0).collect()
    mats = np.stack([np.eye(4), np.eye(4)])
    mats[1, 0, 3] = 3
    np.save(tmp_path / "d.npy", mats)
    np.savez(tmp_path / "e.npz", trajectory=mats, times=np.array([2.0, 4.0]))
    (tmp_path / "f.json").write_text(json.dumps({"poses": mats.tolist(), "timestamps": [2.0, 4.0]}))
    (tmp_path / "g.json").write_text(json.dumps(mats.tolist()))
    for name, times in (("d.npy", [0.0, 0.1]), ("e.npz", [2.0, 4.0]), ("f.json", [2.0, 4.0]), ("g.json", [0.0, 0.1])):
        got = captures.read_poses(spark, str(tmp_path / name), 10.0).orderBy("frame").collect()
        assert [r.ts for r in got] == times and [r.pose[3] for r in got] == [0.0, 3.0]
    (tmp_path / "h.json").write_text(json.dumps({"poses": mats.tolist(), "times": [1.0]}))
    with pytest.raises(Exception, match="not as many times"):
        captures.read_poses(spark, str(tmp_path / "h.json"), 10.0).collect()


def test_trajectory(spark, tmp_path):
    path = tmp_path / "t.txt"
    path.write_text("# a comment\n\n1.0 0 0 0 0 0 0 1\n  2.0\t1 2 3 0 0 0 1  \n")
    got = captures.read_trajectory(spark, str(path)).orderBy("ts").collect()
    assert [(r.line, r.ts, r.pose[3::4]) for r in got] == [(3, 1.0, [0.0, 0.0, 0.0, 1.0]), (4, 2.0, [1.0, 2.0, 3.0, 1.0])]
    path.write_text("1.0 0 0 0 0 0 0 1\n2.0 1 2 3\n")
    with pytest.raises(Exception, match=":2: expected 8 trajectory fields, got 4"):
        captures.read_trajectory(spark, str(path)).collect()
    path.write_text("1.0 0 0 inf 0 0 0 1\n")
    with pytest.raises(Exception, match="finite"):
        captures.read_trajectory(spark, str(path)).collect()


def test_manifest_and_metrics(spark, tmp_path):
    path = tmp_path / "m.json"
    frames = [{"index": 3, "qc_approved": True, "depth_path": "a.png"}, {"index": "4", "status": "accepted", "path": "b.png", "depth_unit": "m"}, {"index": 5, "status": "rejected", "qc_reason": "blurred"}, {"index": 6, "qc_approved": False, "status": "approved"}]
    path.write_text(json.dumps({"depth_unit": "mm", "frames": frames}))
    got = {r["index"]: r for r in captures.read_manifest(spark, str(path)).collect()}
    assert {k: v.approved for k, v in got.items()} == {3: True, 4: True, 5: False, 6: False}
    assert (got[4].depth_path, got[4].depth_unit, got[3].depth_unit, got[5].reason, got[3].scale) == ("b.png", "m", "mm", "blurred", [1.0, 1.0])
    path.write_text(json.dumps({"frames": [{"index": 1}, {"index": 1}]}))
    with pytest.raises(Exception, match="duplicate frame index 1"):
        captures.read_manifest(spark, str(path)).collect()
    path.write_text(json.dumps({"frames": [{"path": "x"}]}))
    with pytest.raises(Exception, match="invalid frame entry"):
        captures.read_manifest(spark, str(path)).collect()
    docs = ['{"loop_closure": {"candidate_count": 5, "loop_edges": 2, "rmse": 0.25}}', '{"accepted_count": 0}', '{"accepted_count": true, "status": "odd"}', "[1]", None, "not json"]
    df = spark.createDataFrame(list(enumerate(docs)), "i int, text string").select("i", captures.loop_metrics(F.col("text")).alias("m"))
    want = [("detected", 5, 2, 0.25), ("none", None, 0, None), ("odd", None, None, None), ("invalid", None, None, None), ("not_reported", None, None, None), ("invalid", None, None, None)]
    assert [tuple(r.m) for r in df.orderBy("i").collect()] == want


def test_depth_truth_and_matrix(spark, tmp_path):
    df = spark.createDataFrame([(1500, "mm"), (2, "Meters")], "d int, u string")
    assert [r.m for r in df.select(captures.depth_metres(F.col("d"), F.col("u")).alias("m")).collect()] == [1.5, 2.0]
    with pytest.raises(Exception, match="unsupported depth unit"):
        df.select(captures.depth_metres(F.col("d"), F.lit("feet"))).collect()
    (tmp_path / "t.csv").write_text("kind,name,value,notes\n wall_length ,kitchen.north_wall, 3.5 ,x\n,b,1,\nheight,c,,\n")
    assert [tuple(r) for r in captures.read_truth(spark, str(tmp_path / "t.csv")).collect()] == [("wall_length", "kitchen.north_wall", 3.5)]
    assert captures.read_reference(spark, str(tmp_path / "t.csv")).count() == 3
    (tmp_path / "k.csv").write_text("517.3,0,318.6\n0,516.5,255.3\n0,0,1\n")
    assert tuple(captures.read_camera_matrix(spark, str(tmp_path / "k.csv")).first())[1:] == (517.3, 516.5, 318.6, 255.3)
    (tmp_path / "k.csv").write_text("1,2\n")
    with pytest.raises(Exception, match="not a 3x3 matrix"):
        captures.read_camera_matrix(spark, str(tmp_path / "k.csv")).collect()


def test_prediction_items(spark):
    docs = ['[{"label": "door"}, {"label": "window"}]', '{"predictions": [{"kind": "door"}]}', '{"labels": ["door", "sofa"], "boxes": [[0, 0, 1, 1], [1, 1, 2, 2]]}', '{"label": "door"}', None, "7"]
    df = spark.createDataFrame(list(enumerate(docs)), "i int, text string").select("i", captures.prediction_items(F.col("text")).alias("x")).orderBy("i")
    got = [[json.loads(v) for v in r.x] for r in df.collect()]
    assert got[0] == [{"label": "door"}, {"label": "window"}] and got[1] == [{"kind": "door"}]
    assert got[2] == [{"label": "door", "bbox": [0, 0, 1, 1], "score": 1.0}, {"label": "sofa", "bbox": [1, 1, 2, 2], "score": 1.0}]
    assert got[3] == [{"label": "door"}] and got[4] == [] and got[5] == []
