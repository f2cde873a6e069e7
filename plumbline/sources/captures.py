"""Readers of a capture's files: poses, trajectories, manifests, predictions, truth.

A path may be a file, a folder or a glob, so that many captures are read at once; `file` tells
them apart.  Files in which the order of lines matters are one row each until their lines are
numbered, as they are small (a line per frame) where the captures are many.  A malformed value
is an error that names it, unless a docstring says otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import records
from ..functions.geometry import quaternion_matrix
from ..operators.asof import nearest

#: Millimetres in a metre, as depth rasters hold them.
MILLI = 1000.0
# File names, keys and aliases must equal those that captures are written with.
POSE_FILES = ("slam_poses.csv", "slam_poses.json", "slam_poses.npy", "slam_poses.npz", "poses.csv", "poses.json", "poses.npy", "poses.npz", "slam/poses.csv")
APPROVED = ("approved", "accepted", "qc_approved")
INDEX_KEYS = ("index", "frame", "frame_index", "frame_id")
DENSE = "metric3d_v2_scale_shift_lidar_residual"
#: From a phone's axes to those of its camera.
DEVICE_TO_CAMERA = ((0.0, 1.0, 0.0), (-1.0, 0.0, 0.0), (0.0, 0.0, 1.0))


def _fail(message: Column, kind: str) -> Column:
    return F.raise_error(message).cast(kind)


def _named_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, their names without blanks and in lower case, with the file and the line's place in it."""
    whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.split("value", r"\r?\n").alias("lines"))
    fields = lambda x: F.transform(F.split(x, ","), lambda v: F.regexp_replace(v, r'^[\s"]+|[\s"]+$', ""))
    rows = whole.select("file", fields(F.col("lines")[0]).alias("names"), F.posexplode(F.slice("lines", 2, F.greatest(F.size("lines") - 1, F.lit(0)))).alias("line", "text"))
    rows = rows.where(F.trim("text") != "").withColumn("values", fields(F.col("text")))
    lower = F.transform("names", lambda v: F.lower(v))
    row = F.map_from_arrays(lower, F.transform(lower, lambda _, i: F.try_element_at(F.col("values"), (i + 1).cast("int"))))
    return rows.select("file", "line", row.alias("row"))


def _get(*names: str) -> Column:
    """The first of the named fields that is there and not blank."""
    at = [F.try_element_at(F.col("row"), F.lit(n)) for n in names]
    return F.coalesce(*[F.when(c != "", c) for c in at])


def _number(*names: str) -> Column:
    return _get(*names).cast("double")


def pose_of(rotation: Column, place: list[Column]) -> Column:
    """The row-major array of sixteen of a rotation of nine and a place."""
    return F.array(*[c for i in range(3) for c in (*[rotation[3 * i + j] for j in range(3)], place[i])], *[F.lit(v) for v in (0.0, 0.0, 0.0, 1.0)])


def _checked(pose: Column, what: Column) -> Column:
    """The pose, or an error unless all of its numbers are finite."""
    bad = F.exists(pose, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(bad, _fail(F.concat(F.lit("a pose is not finite: "), what), "array<double>")).otherwise(pose)


def _quaternion_pose(place: list[Column], q: list[Column]) -> Column:
    return pose_of(quaternion_matrix(*q), place)


def read_odometry(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, ts, pose, fx, fy, cx, cy) of CSV files; lines without a timestamp are left out."""
    x = _named_csv(spark, path).where(_get("timestamp").isNotNull())
    pose = _quaternion_pose([_number(a) for a in "xyz"], [_number(f"q{a}") for a in "xyzw"])
    return x.select("file", "line", _number("timestamp").alias("ts"), _checked(pose, F.concat_ws(":", "file", "line")).alias("pose"), *[_number(c).alias(c) for c in ("fx", "fy", "cx", "cy")])


def pose_priors(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, ts, pose) of odometry files."""
    return read_odometry(spark, path).select("file", "line", "ts", "pose")


def read_pose_table(spark: SparkSession, path: str, fps: float) -> DataFrame:
    """(file, frame, ts, pose) of pose CSV files, ordered by their index column or else by line.

    A row has either m00 to m33 or a place and a quaternion; without a time it gets frame / fps.
    """
    from pyspark.sql import Window

    x = _named_csv(spark, path)
    index = _get(*INDEX_KEYS)
    x = x.withColumn("at", F.when(index.isNull(), F.col("line")).otherwise(index.cast("int")))
    x = x.withColumn("frame", F.row_number().over(Window.partitionBy("file").orderBy("at", "line")) - 1)
    cells = [f"m{r}{c}" for r in range(4) for c in range(4)]
    matrix = F.array(*[_number(c) for c in cells])
    place, turn = [_number(a, f"t{a}") for a in "xyz"], [*[_number(f"q{a}") for a in "xyz"], _number("qw", "w")]
    full = ~F.exists(matrix, lambda v: v.isNull())
    known = F.lit(True)
    for c in (*place, *turn):
        known = known & c.isNotNull()
    where = F.concat_ws(":", "file", "line")
    pose = F.when(full, matrix).when(known, _quaternion_pose(place, turn)).otherwise(_fail(F.concat(F.lit("neither a matrix nor a place and a quaternion: "), where), "array<double>"))
    ts = F.coalesce(_number("timestamp", "time", "t"), F.col("frame") / fps)
    return x.select("file", "frame", ts.alias("ts"), _checked(pose, where).alias("pose"))


def read_pose_json(spark: SparkSession, path: str, fps: float) -> DataFrame:
    """(file, frame, ts, pose) of JSON files: a list of 4x4 matrices, or an object with poses and timestamps."""
    matrices = "array<array<array<double>>>"
    x = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    obj = F.from_json("value", f"poses {matrices}, trajectory {matrices}, timestamps array<double>, times array<double>")
    x = x.select("file", F.when(F.trim("value").startswith("["), F.from_json("value", matrices)).otherwise(F.coalesce(obj["poses"], obj["trajectory"])).alias("poses"), F.coalesce(obj["timestamps"], obj["times"]).alias("times"))
    bad = F.when(F.col("poses").isNull() | (F.size("poses") == 0), "no poses").when(F.col("times").isNotNull() & (F.size("times") != F.size("poses")), "not as many times as poses")
    x = x.withColumn("poses", F.when(bad.isNotNull(), _fail(F.concat(bad, F.lit(": "), F.col("file")), matrices)).otherwise(F.col("poses")))
    rows = x.select("file", "times", F.posexplode("poses").alias("frame", "m"))
    shape = (F.size("m") == 4) & F.forall("m", lambda r: F.size(r) == 4)
    pose = F.when(shape, F.flatten("m")).otherwise(_fail(F.concat(F.lit("a pose is not 4x4: "), F.col("file")), "array<double>"))
    return rows.select("file", "frame", F.coalesce(F.col("times")[F.col("frame")], F.col("frame") / fps).alias("ts"), _checked(pose, F.col("file")).alias("pose"))


def read_pose_arrays(spark: SparkSession, path: str, fps: float) -> DataFrame:
    """(file, frame, ts, pose) of numpy files, .npy or .npz with poses and perhaps timestamps."""

    def load(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io

        import numpy as np

        for part in parts:
            for name, raw in zip(part["path"], part["content"], strict=True):
                found = np.load(io.BytesIO(raw), allow_pickle=False)
                times = None
                if name.endswith(".npz"):
                    poses = next((found[k] for k in ("poses", "pose", "trajectory") if k in found), None)
                    times = next((found[k] for k in ("timestamps", "times", "timestamp") if k in found), None)
                else:
                    poses = found
                if poses is None or poses.ndim != 3 or poses.shape[1:] != (4, 4) or not len(poses):
                    raise ValueError(f"no 4x4 poses in {name}")
                times = np.arange(len(poses)) / fps if times is None else times
                if len(times) != len(poses) or not (np.isfinite(poses).all() and np.isfinite(times).all()):
                    raise ValueError(f"times and poses do not fit in {name}")
                yield pd.DataFrame({"file": name, "frame": np.arange(len(poses)), "ts": times.astype(float), "pose": list(poses.reshape(-1, 16).astype(float))})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(load, "file string, frame int, ts double, pose array<double>")


def read_poses(spark: SparkSession, path: str, fps: float) -> DataFrame:
    """(file, frame, ts, pose), by the kind of file."""
    if path.endswith((".npy", ".npz")):
        return read_pose_arrays(spark, path, fps)
    return read_pose_json(spark, path, fps) if path.endswith(".json") else read_pose_table(spark, path, fps)


def read_trajectory(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, ts, pose) of text files with ts tx ty tz qx qy qz qw on a line; # starts a comment line.

    A line with another number of fields, or with a field that is no finite number, is an error
    that names the line.
    """
    whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.posexplode(F.split("value", r"\r?\n")).alias("line", "text"))
    x = whole.select("file", (F.col("line") + 1).alias("line"), F.split(F.trim(F.regexp_replace("text", r"\s+", " ")), " ").alias("f"))
    x = x.where((F.col("f")[0] != "") & ~F.col("f")[0].startswith("#"))
    where = F.concat_ws(":", "file", "line")
    v = F.transform("f", lambda s: s.try_cast("double"))
    count = F.concat(where, F.lit(": expected 8 trajectory fields, got "), F.size("f").cast("string"))
    bad = F.exists(v, lambda n: n.isNull() | F.isnan(n) | (F.abs(n) == float("inf")))
    v = F.when(F.size("f") != 8, _fail(count, "array<double>")).when(bad, _fail(F.concat(where, F.lit(": fields must be finite numbers")), "array<double>")).otherwise(v)
    x = x.withColumn("v", v)
    n = [F.col("v")[i] for i in range(8)]
    return x.select("file", "line", n[0].alias("ts"), _quaternion_pose(n[1:4], n[4:]).alias("pose"))


def read_imu(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, ts, ax, ay, az) from the first four columns of CSV files; blank lines are left out."""
    whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.posexplode(F.split("value", r"\r?\n")).alias("line", "text"))
    x = whole.select("file", "line", F.transform(F.split("text", ","), lambda v: F.trim(v)).alias("f")).where((F.col("line") > 0) & (F.col("f")[0] != ""))
    return x.select("file", "line", *[F.col("f")[i].cast("double").alias(c) for i, c in enumerate(("ts", "ax", "ay", "az"))])


def gravity(poses: DataFrame, imu: DataFrame, capture: str = "capture") -> DataFrame:
    """(capture, up, consistency): the mean direction of accelerations turned by the pose nearest in time, and how well they agree with it.

    poses(capture, ts, pose), imu(capture, ts, ax, ay, az).  A capture without samples looks up along
    y with a consistency of 0.
    """
    left = imu.select(F.col(capture).alias("c"), F.col("ts").alias("t"), F.struct("ax", "ay", "az").alias("a"))
    right = poses.select(F.col(capture).alias("c"), F.col("ts").alias("t"), F.lit(0).alias("id"), F.col("pose").alias("value"))
    times = left.select("c", "t", F.lit(0).alias("id")).distinct()
    x = nearest(times, right, "c", "t", "id", "value").join(left, ["c", "t"])
    a = [F.col("a.ax"), F.col("a.ay"), F.col("a.az")]
    cam = [sum((k * v for k, v in zip(row, a, strict=True) if k), F.lit(0.0)) for row in DEVICE_TO_CAMERA]
    world = [sum((F.col("match_value")[4 * i + j] * cam[j] for j in range(3)), F.lit(0.0)) for i in range(3)]
    x = x.where("match_value is not null").select("c", *[w.alias(n) for w, n in zip(world, "xyz", strict=True)])
    length = lambda v: F.sqrt(v[0] * v[0] + v[1] * v[1] + v[2] * v[2])
    mean = x.groupBy("c").agg(*[F.avg(n).alias(f"m{n}") for n in "xyz"])
    m = [F.col(f"m{n}") for n in "xyz"]
    mean = mean.select("c", F.array(*[v / length(m) for v in m]).alias("up"))
    w = [F.col(n) for n in "xyz"]
    cosine = sum((v * F.col("up")[i] for i, v in enumerate(w)), F.lit(0.0)) / F.greatest(length(w), F.lit(1e-9))
    out = x.join(mean, "c").groupBy("c").agg(F.first("up").alias("up"), F.avg(F.abs(cosine)).alias("consistency"))
    known = poses.select(F.col(capture).alias("c")).distinct().join(out, "c", "left")
    return known.select(F.col("c").alias(capture), F.coalesce("up", F.array(F.lit(0.0), F.lit(1.0), F.lit(0.0))).alias("up"), F.coalesce("consistency", F.lit(0.0)).alias("consistency"))


def capture_bundle(poses: DataFrame, size: tuple[int, int], depth_size: tuple[int, int], capture: str = "file") -> DataFrame:
    """(capture, n, fps, fx, fy, cx, cy): a row per capture with median intrinsics at the depth size.

    poses(capture, ts, fx, fy, cx, cy).  fps is the inverse of the median step, null for one frame.
    """
    from pyspark.sql import Window

    step = F.col("ts") - F.lag("ts").over(Window.partitionBy(capture).orderBy("ts"))
    sx, sy = depth_size[0] / size[0], depth_size[1] / size[1]
    mid = lambda c, k: (F.median(c) * k).alias(c)
    x = poses.withColumn("step", step).groupBy(capture)
    return x.agg(F.count("*").alias("n"), (1 / F.median(F.when(F.col("step") > 0, F.col("step")))).alias("fps"), mid("fx", sx), mid("fy", sy), mid("cx", sx), mid("cy", sy))


def depth_metres(raw: Column, unit: Column) -> Column:
    """A depth value in metres; a unit other than millimetres or metres is an error."""
    u = F.lower(unit)
    return F.when(u.isin("mm", "millimetres", "millimeters"), raw / MILLI).when(u.isin("m", "metres", "meters"), raw.cast("double")).otherwise(_fail(F.concat(F.lit("unsupported depth unit "), unit), "double"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(file, index, approved, reason, depth_path, confidence_path, qc_path, depth_unit, provenance, scale) of densify manifests.

    An entry without a whole index, or an index that repeats, is an error.
    """
    frame = "struct<index:string,qc_approved:string,status:string,qc_reason:string,depth_path:string,path:string,confidence_path:string,qc_mask_path:string,qc_path:string,depth_unit:string>"
    x = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.from_json("value", f"dense_rgb_scale array<double>, depth_unit string, depth_provenance string, frames array<{frame}>").alias("m"))
    x = x.select("file", "m", F.explode("m.frames").alias("f"))
    index = F.col("f.index").try_cast("int")
    index = F.when(index.isNull(), _fail(F.concat(F.lit("an invalid frame entry in "), F.col("file")), "int")).otherwise(index)
    some = lambda *names: F.coalesce(*[F.when(F.col(f"f.{n}") != "", F.col(f"f.{n}")) for n in names])
    approved = F.when(F.col("f.qc_approved").isNotNull(), records.truth(F.col("f.qc_approved"))).otherwise(F.coalesce(F.col("f.status").isin(*APPROVED), F.lit(False)))
    x = x.select("file", index.alias("index"), approved.alias("approved"), F.coalesce("f.qc_reason", F.lit("")).alias("reason"), some("depth_path", "path").alias("depth_path"), some("confidence_path").alias("confidence_path"), some("qc_mask_path", "qc_path").alias("qc_path"), F.coalesce("f.depth_unit", "m.depth_unit", F.lit("mm")).alias("depth_unit"), F.coalesce("m.depth_provenance", F.lit(DENSE)).alias("provenance"), F.coalesce("m.dense_rgb_scale", F.array(F.lit(1.0), F.lit(1.0))).alias("scale"))
    from pyspark.sql import Window

    again = F.count("*").over(Window.partitionBy("file", "index")) > 1
    twice = _fail(F.concat(F.lit("duplicate frame index "), F.col("index").cast("string"), F.lit(" in "), F.col("file")), "int")
    return x.withColumn("index", F.when(again, twice).otherwise(F.col("index")))


def loop_metrics(text: Column) -> Column:
    """(status, candidates, accepted, residual) of a metrics document; a null text is `not_reported`, no object is `invalid`.

    Counts must be whole numbers and a residual finite; others are null.
    """
    counts = "candidate_count string, loop_candidates string, accepted_count string, loop_edges string, residual string, rmse string, status string"
    outer = F.from_json(text, "map<string,string>")
    inner = F.try_element_at(outer, F.lit("loop_closure"))
    doc = F.from_json(F.coalesce(inner, text), counts)
    fields = F.from_json(F.coalesce(inner, text), "map<string,string>")
    first = lambda *names: F.coalesce(*[F.when(F.map_contains_key(fields, n), F.coalesce(doc[n], F.lit(""))) for n in names])
    whole = lambda *names: F.when(first(*names).rlike(r"^-?\d+$"), first(*names).try_cast("int"))
    accepted = whole("accepted_count", "loop_edges")
    said = F.when(doc["status"].isNotNull(), doc["status"])
    bad = outer.isNull() | ~F.ltrim(F.coalesce(inner, text)).startswith("{")
    state = F.when(text.isNull(), "not_reported").when(bad, "invalid").otherwise(F.coalesce(said, F.when(accepted > 0, "detected").otherwise("none")))
    ok = text.isNotNull() & ~bad
    return F.struct(state.alias("status"), F.when(ok, whole("candidate_count", "loop_candidates")).alias("candidates"), F.when(ok, accepted).alias("accepted"), F.when(ok, records.finite(first("residual", "rmse"))).alias("residual"))


def prediction_items(text: Column) -> Column:
    """The items of a predictions document as an array of JSON objects.

    A list, an object with a list under openings, predictions, instances, detections or objects, an
    object with labels, boxes and perhaps scores (1 where there are none), or one object alone.
    """
    v = F.try_parse_json(text)
    pick = lambda *names, kind: F.coalesce(*[F.try_variant_get(v, f"$.{n}", kind) for n in names])
    items = F.coalesce(F.try_variant_get(v, "$", "array<variant>"), pick("openings", "predictions", "instances", "detections", "objects", kind="array<variant>"))
    labels, boxes = pick("labels", "classes", kind="array<string>"), pick("boxes", "bboxes", kind="array<array<double>>")
    scores = F.coalesce(pick("scores", "confidences", kind="array<double>"), F.transform(labels, lambda _: F.lit(1.0)))
    n = F.least(F.size(labels), F.size(boxes), F.size(scores))
    zipped = F.transform(F.slice(F.arrays_zip(labels.alias("label"), boxes.alias("bbox"), scores.alias("score")), 1, n), lambda r: F.to_json(r))
    alone = F.when(F.ltrim(text).startswith("{"), F.array(text))
    return F.coalesce(F.transform(items, lambda i: F.to_json(i)), zipped, alone, F.array().cast("array<string>"))


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    """(kind, name, value) of truth CSV files; rows without a kind or a value are left out."""
    x = spark.read.csv(path, header=True, inferSchema=False)
    ok = (F.coalesce("kind", F.lit("")) != "") & (F.coalesce("value", F.lit("")) != "")
    return x.where(ok).select(F.trim("kind").alias("kind"), F.trim("name").alias("name"), F.trim("value").cast("double").alias("value"))


def read_reference(spark: SparkSession, path: str) -> DataFrame:
    """A reference CSV, every column as text."""
    return spark.read.csv(path, header=True, inferSchema=False)


def read_camera_matrix(spark: SparkSession, path: str) -> DataFrame:
    """(file, fx, fy, cx, cy) of CSV files with a 3x3 matrix; another shape is an error."""
    x = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.filter(F.split("value", r"\r?\n"), lambda s: F.trim(s) != "").alias("rows"))
    m = F.transform("rows", lambda r: F.transform(F.split(r, ","), lambda c: F.trim(c).cast("double")))
    x = x.withColumn("m", m)
    ok = (F.size("m") == 3) & F.forall("m", lambda r: F.size(r) == 3)
    x = x.withColumn("m", F.when(ok, F.col("m")).otherwise(_fail(F.concat(F.lit("not a 3x3 matrix: "), F.col("file")), "array<array<double>>")))
    return x.select("file", F.col("m")[0][0].alias("fx"), F.col("m")[1][1].alias("fy"), F.col("m")[0][2].alias("cx"), F.col("m")[1][2].alias("cy"))
