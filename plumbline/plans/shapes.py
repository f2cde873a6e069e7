"""Queries of poses, frames, walls, planes and measurement records, with their SQL."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..functions import frames, geometry, measures, poses, records
from ..operators import frame_contract, posegraph, rooms, scoring
from ..sources.tables import SQL, regions, table
from .series import r6


def _e(i: int):
    return F.col("embedding")[i].cast("double")


def _pose_rows(s, d):
    """(id, graph, a, b, t, ra, rb, pa, pb): two unit quaternions, a share, their rotations and two poses of each row."""
    x = table(s, d, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("label").alias("graph"), "embedding",
        poses.unit(F.array(*[_e(i) for i in range(4)])).alias("a"), poses.unit(F.array(*[_e(i) for i in range(4, 8)])).alias("b"), (F.pmod("vec_id", F.lit(11)) / 10.0).alias("t"),
    )
    for q, r in (("a", "ra"), ("b", "rb")):
        x = x.withColumn(r, geometry.quaternion_matrix(*[F.col(q)[i] for i in range(4)]))
    for r, p, at in (("ra", "pa", 8), ("rb", "pb", 11)):
        rows = [c for i in range(3) for c in (*[F.col(r)[3 * i + j] for j in range(3)], _e(at + i))]
        x = x.withColumn(p, F.array(*rows, *[F.lit(v) for v in (0.0, 0.0, 0.0, 1.0)]))
    return x


def pose_slerp(s, d):
    """A rotation between two, and a matrix taken back to its quaternion."""
    x = _pose_rows(s, d).withColumn("m", poses.slerp(F.col("a"), F.col("b"), F.col("t"))).withColumn("back", poses.matrix_quaternion(F.col("ra")))
    cols = [F.round(F.col(c)[i], 6).alias(f"{c}{i}") for c in ("m", "back") for i in range(4)]
    return x.select("id", *cols, F.round(geometry.rotation_degrees(F.col("ra"), F.col("rb")), 5).alias("degrees"))


def pose_graph(s, d):
    """Scores of a graph per label: each row measures the pose of the row before it in its label."""
    x = _pose_rows(s, d)
    nodes = x.select("graph", F.col("id").alias("node"), F.col("pa").alias("pose"))
    edges = x.select("graph", F.col("id").alias("source"), (F.col("id") - 10).alias("target"), F.col("pb").alias("measured"), F.when(F.pmod("id", F.lit(5)) == 0, 10.0).otherwise(1000.0).alias("information"), (F.pmod("id", F.lit(5)) == 0).alias("is_loop"))
    scores = posegraph.graph_scores(posegraph.constraint_errors(nodes, edges))
    return posegraph.with_constant(nodes.select("graph").distinct(), scores).select("graph", *r6("objective", "loop_residual"))


def image_turns(s, d):
    """How each camera's image is turned upright, and a box in it; the intrinsics at half width."""
    x = _pose_rows(s, d).withColumn("turn", poses.display_rotation(F.col("pa"), [F.lit(0.0), F.lit(1.0), F.lit(0.0)]))
    b = poses.rotated_box([F.lit(10.0), F.lit(20.0), F.lit(30.0), F.lit(60.0)], F.lit(640.0), F.lit(480.0), F.col("turn"))
    k = poses.scaled_intrinsics(_e(0) + 500, _e(1) + 500, F.lit(320.0), F.lit(240.0), (F.lit(640.0), F.lit(480.0)), (F.lit(320.0), F.lit(480.0)))
    x = x.select("id", "turn", b.alias("b"), k.alias("k"))
    return x.select("id", "turn", *[F.col("b")[i].alias(f"b{i}") for i in range(4)], F.round("k.fx", 6).alias("fx"), F.round("k.fy", 6).alias("fy"), "k.cx", "k.cy")


def _walls(s, d):
    """(id, label, start, end, normal, seen): a segment in the plane per row, its normal to the left."""
    x = table(s, d, "embeddings").select(F.col("vec_id").alias("id"), "label", _e(0).alias("x0"), _e(1).alias("y0"), (_e(2) * 3).alias("x1"), (_e(3) * 3).alias("y1"), F.abs(_e(4) * 4).alias("seen"))
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    x = x.withColumn("length", F.hypot(dx, dy)).where("length > 0")
    return x.withColumn("dx", dx / F.col("length")).withColumn("dy", dy / F.col("length"))


def wall_frames(s, d):
    """Distances to and along walls, what of them was inferred, and walls turned onto the axes."""
    v = lambda *n: [F.col(c) for c in n]
    x = _walls(s, d).withColumn("w", frames.snapped_wall([-F.col("dy"), F.col("dx")], v("x0", "y0"), v("x1", "y1")))
    zero, n = [F.lit(0.0), F.lit(0.0)], [-F.col("dy"), F.col("dx")]
    cols = {
        "away": frames.signed_distance(zero, n, geometry.dot(n, v("x0", "y0"))),
        "along": frames.along(zero, v("x0", "y0"), v("dx", "dy")),
        "inferred": frames.inferred_fraction(F.col("length"), F.lit(0.0), F.col("seen")),
        **{c: F.col(f"w.{c}") for c in ("nx", "ny", "offset")},
        "half": F.hypot(F.col("w.x1") - F.col("w.x0"), F.col("w.y1") - F.col("w.y0")) / 2,
    }
    return x.select("id", F.col("w.off_axis").alias("off_axis"), *[F.round(c + 0.0, 5).alias(k) for k, c in cols.items()])


def wall_meetings(s, d):
    """Where each wall's line meets that of the next of its label, and whether the sight line between their starts passes a third."""
    x = _walls(s, d)
    other = x.select("label", (F.col("id") - 10).alias("id"), *[F.col(c).alias(f"o{c}") for c in ("x0", "y0", "x1", "y1", "dx", "dy")])
    y = x.join(other, ["label", "id"])
    v = lambda *n: [F.col(c) for c in n]
    met = frames.walls_meet(v("x0", "y0"), v("dx", "dy"), v("ox0", "oy0"), v("odx", "ody"))
    crossed = frames.ray_crosses(v("x1", "y1"), [F.lit(0.0), F.lit(0.0)], v("ox0", "oy0"), v("ox1", "oy1"), F.lit(0.1))
    y = y.select("id", met.alias("m"), crossed.alias("crossed"))
    return y.select("id", "crossed", *[F.round(F.col(f"m.{c}"), 4).alias(c) for c in ("x", "y", "ta", "tb")])


def wall_order(s, d):
    """The longest walls of each label, in the order in which walls are put out."""
    from pyspark.sql import Window

    v = lambda *n: [F.col(c) for c in n]
    n = [-F.col("dy"), F.col("dx")]
    x = _walls(s, d)
    inliers = F.pmod("id", F.lit(7))
    key = frames.geometry_key(n, geometry.dot(n, v("x0", "y0")), v("x0", "y0"), v("x1", "y1"))
    place = F.row_number().over(Window.partitionBy("label").orderBy(*frames.output_rank(inliers, F.round("length", 1), key)))
    fitted = F.row_number().over(Window.partitionBy("label").orderBy(*frames.fit_rank(inliers, F.round("length", 1), F.round("seen", 1), key)))
    return x.select("label", "id", place.alias("place"), fitted.alias("fitted"))


def plane_triples(s, d):
    """The plane through three points of each row, its class against up = z, and whether its first point is in the wall band."""
    p = [[_e(3 * k + i) for i in range(3)] for k in range(3)]
    x = table(s, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding", frames.plane_from_three(*p).alias("p")).where("p is not null")
    kind = frames.plane_class(F.col("p.nz"), _e(2) * 10, F.lit(0.0), _e(2) < -0.1)
    band = frames.in_wall_band(_e(2) * 10, F.col("p.nz"), F.lit(-1.0), F.when(F.pmod("id", F.lit(2)) == 0, 2.0))
    return x.select("id", *[F.round(F.col(f"p.{c}"), 5).alias(c) for c in ("nx", "ny", "nz", "offset")], kind["name"].alias("kind"), kind["quarantined"].alias("quarantined"), band.alias("band"))


def room_heights(s, d):
    """Ceiling height over the floor at a plan point, for tilted planes."""
    up, right, forward = ([F.lit(float(i == k)) for i in range(3)] for k in (2, 0, 1))
    floor, ceiling = ([_e(0), _e(1), F.lit(1.0)], F.lit(0.1)), ([_e(3), _e(4), _e(5) * 4], 2.5 * _e(5) * 4)
    foot = frames.to_world([_e(6), _e(7)], F.lit(0.0), right, forward, up)
    x = table(s, d, "embeddings").select(F.col("vec_id").alias("id"), F.round(frames.room_height_at(floor, ceiling, foot, up), 5).alias("height"), *[F.round(c, 6).alias(k) for c, k in zip(frames.to_plan(foot, right, forward), ("u", "v"), strict=True)])
    return x


def offset_rooms(s, d):
    """Rectangles with each side moved out by its own distance."""
    w, h = F.abs(_e(0)) * 10 + 1, F.abs(_e(1)) * 10 + 1
    at = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    zero = F.lit(0.0)
    square = F.array(at(zero, zero), at(w, zero), at(w, h), at(zero, h))
    out = frames.offset_polygon(square, F.array(*[F.abs(_e(i)) for i in range(2, 6)]))
    return table(s, d, "embeddings").select(F.col("vec_id").alias("id"), out.alias("p")).select("id", F.round(geometry.signed_area(F.col("p")), 5).alias("area"), F.round(F.col("p")[0]["x"], 5).alias("x0"), F.round(F.col("p")[2]["y"], 5).alias("y2"))


_WORDS = ["Door", " entry. ", "Window", "pass_through", "ARCH way", "archway;", "sofa", "", "door way", "windows", None, "entrance:"]
_TRUTHS = ["yes", "No", "0", "observed", "maybe", None, " ", "FALSE", "validated", "missing", "none", "1"]


def record_fields(s, d):
    """Kinds, truth values, ranges and boxes read from loose fields of events."""
    pick = lambda words: F.element_at(F.array(*[F.lit(w) for w in words]), (F.pmod("event_id", F.lit(12)) + 1).cast("int"))
    v = F.col("value")
    raw = F.when(F.pmod("event_id", F.lit(5)) == 0, "x").when(F.pmod("event_id", F.lit(5)) == 1, "Infinity").otherwise(v.cast("string"))
    x = table(s, d, "events").select("event_id", "value", pick(_WORDS).alias("word"), pick(_TRUTHS).alias("yes"), raw.alias("raw"))
    u = records.metric_range(F.struct(F.lit(None).cast("double").alias("low"), v.alias("high")), v, F.pmod("event_id", F.lit(3)) - 1.0)
    b = records.box_pixels(records.box(v / 1000, F.lit(0.5), F.lit(0.1), F.lit(0.2)), F.lit(100.0), F.lit(200.0), F.when(F.pmod("event_id", F.lit(2)) == 0, "1000"))
    names = F.create_map(F.lit("north wall"), F.lit(3))
    wall = F.when(F.pmod("event_id", F.lit(3)) == 0, "north wall").when(F.pmod("event_id", F.lit(3)) == 1, F.concat(F.lit(" "), F.pmod("event_id", F.lit(9)))).otherwise("w2")
    source = records.provenance(F.array(F.lit(" RGB"), F.col("word"), F.lit("rgb")))
    x = x.select("event_id", records.opening_kind(F.col("word")).alias("kind"), records.truth(F.col("yes"), True).alias("truth"), F.round(records.finite(F.col("raw"), -1.0), 6).alias("number"), u.alias("u"), b.alias("b"), records.wall_index(wall, names).alias("wall"), F.array_join(source, "+").alias("source"), F.round(records.sigma_of(F.create_map(F.lit("s"), F.col("raw")), "s"), 6).alias("sigma"))
    return x.select("event_id", "kind", "truth", "number", F.round("u.low", 6).alias("low"), F.round("u.high", 6).alias("high"), *[F.round(F.col("b")[i], 6).alias(f"b{i}") for i in range(4)], "wall", "source", F.when(F.col("sigma") < 1e9, F.col("sigma")).alias("sigma"))


def _evidence(r):
    k = F.col("id")
    pick = lambda *w: F.element_at(F.array(*[F.lit(x) for x in w]), (F.pmod(k, F.lit(len(w))) + 1).cast("int"))
    return F.struct((F.col("area") / 60).alias("rms"), F.pmod(k, F.lit(700)).alias("points"), F.when(F.pmod(k, F.lit(4)) > 0, F.pmod(k, F.lit(100)) * 1.0).alias("density"), pick("arkit_refined", "raw", "unknown", "arkit").alias("pose"), pick("tls_lidar", "monocular", "unknown").alias("depth"), pick("calibrated", "uncalibrated").alias("calibration"), (F.col("v0") / 10).alias("pose_sigma"))


def measurement_records(s, d):
    """Measurements with tolerance, confidence and flags from their evidence, and an opening's half-width."""
    r = regions(s, d)
    m = measures.measurement(F.col("area"), _evidence(r), "region area", inferred=F.pmod("id", F.lit(3)) == 0, coverage=0.95, scale=1.2)
    w = measures.opening_half_width(F.lit(0.04), F.pmod("id", F.lit(10)) / 10.0, F.col("v0") / 100, F.pmod("id", F.lit(2)) == 0)
    i = measures.interval(F.col("area"), w)
    x = r.select("id", m.alias("m"), i.alias("i"))
    return x.select("id", F.round("m.value", 7).alias("value"), F.round("m.tolerance", 6).alias("tolerance"), F.round("m.confidence", 6).alias("confidence"), F.array_join("m.flags", "+").alias("flags"), F.round("i.half_width", 4).alias("half_width"))


def evidence_by_room(s, d):
    """Evidence of each room's regions as one."""
    r = regions(s, d)
    e = r.select("room_id", _evidence(r).alias("e")).select("room_id", "e.*")
    return e.groupBy("room_id").agg(*measures.combined_evidence()).select("room_id", "points", *r6("rms", "density", "pose_sigma"))


def scale_checks(s, d):
    """Known lengths against observed ones, as user references, doors and nonsense."""
    r = regions(s, d)
    kind = F.element_at(F.array(*[F.lit(x) for x in ("user", "User supplied", "door", "tape")]), (F.pmod("id", F.lit(4)) + 1).cast("int"))
    v = measures.scale_validation(F.when(F.pmod("id", F.lit(5)) > 0, F.col("width") - 0.4), F.col("height_extent") + 0.1, kind, F.when(F.pmod("id", F.lit(3)) == 0, 0.05))
    return r.select("id", v.alias("v")).select("id", "v.kind", "v.status", F.round("v.factor", 5).alias("factor"), F.round("v.tolerance", 6).alias("tolerance"), F.round("v.confidence", 6).alias("confidence"))


def plane_candidates(s, d):
    """Horizontal plane candidates judged by support, residual and quality."""
    r = regions(s, d)
    p = measures.plane_fit(F.col("v1"), F.pmod("id", F.lit(300)), F.col("area") / 50, F.col("v0"), F.floor(F.col("area") * 1000) / 1e5, 100, F.lit(400))
    return r.select("id", p.alias("p")).select("id", F.round("p.height", 6).alias("height"), F.round("p.confidence", 6).alias("confidence"), "p.status", F.round("p.support", 6).alias("support"), F.round("p.adaptive_limit", 6).alias("adaptive_limit"), F.array_join("p.reasons", "+").alias("reasons"))


def refinement_gate(s, d):
    """How many reasons speak against each refined trajectory, and the first words of each."""
    r = regions(s, d)
    a = measures.refinement_accepted(F.col("area") / 2, F.lit(0.75), F.pmod("id", F.lit(3)), F.col("v1"), F.col("v0") * 2, F.when(F.pmod("id", F.lit(4)) > 0, F.col("v1")), F.col("v0") * 1.5, F.col("width"), F.col("height_extent"))
    firsts = F.transform(a, lambda x: F.concat_ws(" ", F.slice(F.split(x, " "), 1, 2)))
    return r.select("id", F.size(a).alias("n"), F.array_join(firsts, "+").alias("reasons"))


def region_texts(s, d):
    """Sentences about damage regions, with lengths that no rounding can turn."""
    r = regions(s, d)
    area, v0, v1 = (F.pmod("id", F.lit(k)) / 4.0 for k in (40, 3, 9))
    return r.select("id", records.region_text(F.col("surface_key"), area, F.col("damage_class"), F.col("combined_classes"), F.col("water_category"), F.col("subtype"), v0, v1).alias("text"))


def _comparisons(s, d):
    """(kind, truth, predicted, half_width): measures of regions against themselves, a few centimetres off."""
    r = regions(s, d)
    kind = F.element_at(F.array(*[F.lit(k) for k in ("wall_length", "ceiling_height", "floor_area", "opening_width", "damage_area")]), (F.pmod("id", F.lit(5)) + 1).cast("int"))
    return r.select(kind.alias("kind"), (F.col("area") + 0.5).alias("truth"), (F.col("area") + 0.5 + F.pmod("id", F.lit(7)) / 128.0).alias("predicted"), (F.pmod("id", F.lit(11)) / 100.0).alias("half_width"))


def gate_table(s, d):
    """How many measures pass each gate, as the scorer states them."""
    return scoring.gate_table(_comparisons(s, d)).drop("label")


def interval_report(s, d):
    """Errors in millimetres and interval coverage of each kind of measure."""
    return scoring.interval_report(_comparisons(s, d))


def water_scores(s, d):
    """Category and class of each surface's largest water region against a reference of their own."""
    r = regions(s, d)
    found = r.select(F.col("surface_key").alias("surface"), "damage_class", "area", "id", "water_category", "water_class")
    asked = r.groupBy(F.col("surface_key").alias("surface")).agg(F.min("id").alias("k"))
    pick = lambda n, least: F.when(F.pmod("k", F.lit(n)) >= least, F.pmod("k", F.lit(n)).cast("string")).otherwise("")
    return scoring.water_scores(found, asked.select("surface", pick(4, 1).alias("water_category"), pick(3, 2).alias("water_class")))


def room_neighbours(s, d):
    """Which line numbers share a part with which, for each supplier, as rooms share walls."""
    x = table(s, d, "lineitem").select(F.col("l_suppkey").alias("scene"), F.col("l_partkey").alias("wall"), F.col("l_linenumber").alias("room"))
    return rooms.room_neighbours(x, "scene")


def strided_frames(s, d):
    """Every third event of each user, as frames are thinned."""
    x = table(s, d, "events").select("user_id", "event_id")
    return frame_contract.strided(x, "user_id", "event_id", 3)


def _frames(s, d):
    k = F.col("vec_id")
    eye = F.array(*[F.lit(float(i % 5 == 0)) for i in range(16)])
    flat = F.array(*[F.lit(float(i in (0, 5, 15))) for i in range(16)])
    pose = F.when(F.pmod(k, F.lit(17)) == 0, F.lit(None)).when(F.pmod(k, F.lit(19)) == 0, flat).otherwise(eye)
    approved = F.when(F.pmod(k, F.lit(4)) == 0, True).when(F.pmod(k, F.lit(4)) == 1, False)
    return table(s, d, "embeddings").select(F.col("label").alias("capture"), k.alias("index"), pose.alias("pose"), (k / 30.0).alias("ts"), approved.alias("approved"), F.when(F.pmod(k, F.lit(8)) == 0, "torn").alias("dense_error"), F.when(F.pmod(k, F.lit(3)) == 0, "blurred").alias("dense_reason"), F.lit(None).cast("string").alias("dense_provenance"), (F.pmod(k, F.lit(5)) > 0).alias("has_raw"))


def frame_decisions(s, d):
    """What each frame is rebuilt from, and why, where dense depth is preferred."""
    return frame_contract.decide(_frames(s, d)).select("index", "decision", "reason", "source", "fallback")


def frame_report(s, d):
    """Counts of what became of each capture's frames."""
    x = frame_contract.contract_report(frame_contract.decide(_frames(s, d)))
    return x.select("capture", "selected_frames", "densified_frames", "qc_approved_dense_frames", "fused_frames", "fused_dense_frames", "fused_raw_frames", "rejected_frames", "fallback_frames", "rejected_frames_total")


_E = "SELECT vec_id AS id, label, " + ", ".join(f"embedding[{i + 1}]::DOUBLE AS e{i}" for i in range(14)) + " FROM embeddings"
_Q = "[1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w), 2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w), 2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)]"


def _matrix(**names: str) -> str:
    return re.sub(r"[xyzw]", lambda m: names[m[0]], _Q)


_POSE = f"""e AS ({_E}), u AS (SELECT *, sqrt(e0*e0+e1*e1+e2*e2+e3*e3) AS na, sqrt(e4*e4+e5*e5+e6*e6+e7*e7) AS nb, (id % 11) / 10.0::DOUBLE AS t FROM e),
q AS (SELECT *, e0/na AS ax, e1/na AS ay, e2/na AS az, e3/na AS aw, e4/nb AS bx, e5/nb AS by_, e6/nb AS bz, e7/nb AS bw FROM u),
p AS (SELECT *, {_matrix(x='ax', y='ay', z='az', w='aw')} AS ra, {_matrix(x='bx', y='by_', z='bz', w='bw')} AS rb, ax*bx + ay*by_ + az*bz + aw*bw AS c FROM q)"""
_R = "WITH " + SQL["regions"]
_WALL = f"""e AS ({_E}), s AS (SELECT id, label, e0 AS x0, e1 AS y0, e2 * 3 AS x1, e3 * 3 AS y1, abs(e4 * 4) AS seen FROM e),
l AS (SELECT *, sqrt((x1-x0)*(x1-x0) + (y1-y0)*(y1-y0)) AS length FROM s), w AS (SELECT *, (x1-x0)/length AS dx, (y1-y0)/length AS dy FROM l WHERE length > 0)"""
_EV = f"""{_R}, v AS (SELECT id, room_id, area, v0, area / 60 AS rms, id % 700 AS points, CASE WHEN id % 4 > 0 THEN (id % 100)::DOUBLE END AS density, ['arkit_refined', 'raw', 'unknown', 'arkit'][(id % 4 + 1)::INT] AS pose,
 ['tls_lidar', 'monocular', 'unknown'][(id % 3 + 1)::INT] AS depth, id % 2 = 0 AS calibrated, v0 / 10 AS pose_sigma FROM regions)"""
_LIST = lambda words: "[" + ", ".join("NULL" if w is None else f"'{w}'" for w in words) + "]"

_CMP = f"""{_R}, c AS (SELECT ['wall_length', 'ceiling_height', 'floor_area', 'opening_width', 'damage_area'][(id % 5 + 1)::INT] AS kind, area + 0.5 AS truth, area + 0.5 + (id % 7) / 128.0::DOUBLE AS predicted, (id % 11) / 100.0::DOUBLE AS half_width FROM regions),
e AS (SELECT *, abs(predicted - truth) AS e FROM c)"""
_FR = """WITH f AS (SELECT vec_id AS "index", label AS capture, vec_id % 17 = 0 AS lost, vec_id % 19 = 0 AS flat, vec_id % 4 AS k, vec_id % 8 = 0 AS torn, vec_id % 3 = 0 AS blurred, vec_id % 5 > 0 AS raw FROM embeddings),
w AS (SELECT *, CASE WHEN k = 0 AND torn THEN 'torn' WHEN k = 1 THEN CASE WHEN blurred THEN 'blurred' ELSE 'manifest entry is not qc_approved' END END AS why FROM f),
d AS (SELECT *, CASE WHEN lost THEN 'pose/timestamp table has no matching frame' WHEN flat THEN 'pose rotation/linear part is singular' WHEN k = 0 AND NOT torn THEN NULL WHEN raw THEN NULL
 WHEN why IS NOT NULL THEN CASE WHEN k = 0 THEN 'dense frame rejected: ' || why ELSE why END ELSE 'no QC-approved dense depth and no raw LiDAR depth' END AS reason FROM w),
x AS (SELECT *, CASE WHEN reason IS NOT NULL THEN 'rejected' WHEN k = 0 AND NOT torn THEN 'dense' ELSE 'raw' END AS decision,
 CASE WHEN NOT lost AND NOT flat AND why IS NOT NULL AND raw THEN CASE WHEN k = 0 THEN 'dense frame rejected (' || why || ')' ELSE why END || '; raw LiDAR used' END AS fallback FROM d)"""

QUERIES = {f.__name__: f for f in (pose_slerp, pose_graph, image_turns, wall_frames, wall_meetings, wall_order, plane_triples, room_heights, offset_rooms, record_fields, measurement_records, evidence_by_room, scale_checks, plane_candidates, refinement_gate, region_texts, gate_table, interval_report, water_scores, room_neighbours, strided_frames, frame_decisions, frame_report)}

ORACLES = {
    "pose_slerp": f"""WITH {_POSE}, th AS (SELECT *, acos(least(1, abs(c))) AS th, CASE WHEN c < 0 THEN -1 ELSE 1 END AS sg FROM p),
k AS (SELECT *, CASE WHEN abs(c) > 0.9995 THEN 1 - t ELSE sin((1 - t) * th) / sin(th) END AS ka, CASE WHEN abs(c) > 0.9995 THEN t ELSE sin(t * th) / sin(th) END * sg AS kb, ra[1] + ra[5] + ra[9] AS tr FROM th),
m AS (SELECT *, [ka*ax + kb*bx, ka*ay + kb*by_, ka*az + kb*bz, ka*aw + kb*bw] AS r,
 CASE WHEN tr > 0 THEN aw WHEN ra[1] >= ra[5] AND ra[1] >= ra[9] THEN ax WHEN ra[5] >= ra[9] THEN ay ELSE az END AS lead FROM k),
n AS (SELECT *, CASE WHEN abs(c) > 0.9995 THEN sqrt(list_sum(list_transform(r, lambda v: v * v))) ELSE 1 END AS rn, CASE WHEN lead < 0 THEN -1 ELSE 1 END AS s FROM m)
SELECT id, {", ".join(f"round(r[{i + 1}] / rn, 6) AS m{i}" for i in range(4))}, round(s * ax, 6) AS back0, round(s * ay, 6) AS back1, round(s * az, 6) AS back2, round(s * aw, 6) AS back3,
 round(degrees(acos(greatest(-1, least(1, (list_sum(list_transform(range(1, 10), lambda i: ra[i] * rb[i])) - 1) / 2)))), 5) AS degrees FROM n""",
    "pose_graph": f"""WITH {_POSE}, j AS (SELECT a.label AS graph, a.id, t.ra AS rt, a.ra AS rs, a.rb AS rm, [a.e8 - t.e8, a.e9 - t.e9, a.e10 - t.e10] AS mv, [a.e11, a.e12, a.e13] AS tm FROM p a JOIN p t ON t.label = a.label AND t.id = a.id - 10),
x AS (SELECT *, list_transform(range(3), lambda i: list_sum(list_transform(range(3), lambda k: rt[3*k+i+1] * mv[k+1]))) AS tp,
 list_transform(range(9), lambda n: list_sum(list_transform(range(3), lambda k: rt[3*k + n//3 + 1] * rs[3*k + n%3 + 1]))) AS rp FROM j),
er AS (SELECT *, sqrt(list_sum(list_transform(range(1, 4), lambda i: (tp[i] - tm[i]) * (tp[i] - tm[i])))) AS metres, acos(greatest(-1, least(1, (list_sum(list_transform(range(1, 10), lambda i: rp[i] * rm[i])) - 1) / 2))) AS rad, CASE WHEN id % 5 = 0 THEN 10.0 ELSE 1000.0 END::DOUBLE AS info FROM x),
g AS (SELECT graph, sum(info * (metres * metres + 0.0625::DOUBLE * rad * rad)) / sum(info) AS objective, avg(CASE WHEN id % 5 = 0 THEN sqrt(metres * metres + 0.0625::DOUBLE * rad * rad) END) AS lr FROM er GROUP BY graph)
SELECT l.label AS graph, round(coalesce(objective, 0), 6) AS objective, round(lr, 6) AS loop_residual FROM (SELECT DISTINCT label FROM p) l LEFT JOIN g ON g.graph = l.label""",
    "image_turns": f"""WITH {_POSE}, g AS (SELECT id, e0, e1, CASE WHEN abs(ra[4]) >= abs(ra[5]) THEN CASE WHEN ra[4] > 0 THEN 270 ELSE 90 END WHEN ra[5] < 0 THEN 0 ELSE 180 END AS turn FROM p)
SELECT id, turn, CASE turn WHEN 0 THEN 10 WHEN 90 THEN 420 WHEN 270 THEN 20 ELSE 610 END::DOUBLE AS b0, CASE turn WHEN 0 THEN 20 WHEN 90 THEN 10 WHEN 270 THEN 610 ELSE 420 END::DOUBLE AS b1,
 CASE turn WHEN 0 THEN 30 WHEN 90 THEN 460 WHEN 270 THEN 60 ELSE 630 END::DOUBLE AS b2, CASE turn WHEN 0 THEN 60 WHEN 90 THEN 30 WHEN 270 THEN 630 ELSE 460 END::DOUBLE AS b3,
 round((e0 + 500) / 2, 6) AS fx, round(e1 + 500, 6) AS fy, 160.0::DOUBLE AS cx, 240.0::DOUBLE AS cy FROM g""",
    "wall_frames": f"""WITH {_WALL}, a AS (SELECT *, atan2(dx, -dy) AS an, (round_even(atan2(dx, -dy) / (pi() / 2), 0)::INT + 4) % 4 AS qt, (x0 + x1) / 2 AS mx, (y0 + y1) / 2 AS my FROM w),
o AS (SELECT *, abs(degrees(an - qt * (pi() / 2))) > 8 AS off, CASE WHEN qt % 2 = 1 THEN 0.0 ELSE 1.0 END::DOUBLE AS sx, CASE WHEN qt % 2 = 1 THEN 1.0 ELSE 0.0 END::DOUBLE AS sy FROM a)
SELECT id, off AS off_axis, round(dy * x0 - dx * y0, 5) + 0.0 AS away, round(-x0 * dx - y0 * dy, 5) + 0.0 AS along, round(greatest(0, least(1, 1 - seen / length)), 5) AS inferred,
 round(CASE WHEN off THEN -dy ELSE sx END, 5) + 0.0 AS nx, round(CASE WHEN off THEN dx ELSE sy END, 5) + 0.0 AS ny, round(CASE WHEN off THEN -dy * mx + dx * my ELSE sx * mx + sy * my END, 5) + 0.0 AS "offset", round(length / 2, 5) AS half FROM o""",
    "wall_meetings": f"""WITH {_WALL}, j AS (SELECT a.*, b.x0 AS ox, b.y0 AS oy, b.x1 AS px, b.y1 AS py, b.dx AS ex, b.dy AS ey FROM w a JOIN w b ON b.label = a.label AND b.id = a.id + 10),
m AS (SELECT *, dx * ey - dy * ex AS det, CASE WHEN abs(dx * ey - dy * ex) >= 0.15 THEN ((ox - x0) * ey - (oy - y0) * ex) / (dx * ey - dy * ex) END AS ta, -x1 * (py - oy) + y1 * (px - ox) AS rd FROM j),
r AS (SELECT *, CASE WHEN abs(rd) >= 1e-9 THEN ((ox - x1) * (py - oy) - (oy - y1) * (px - ox)) / rd END AS rt, CASE WHEN abs(rd) >= 1e-9 THEN (-(ox - x1) * y1 + (oy - y1) * x1) / rd END AS rs FROM m)
SELECT id, coalesce(rt > 0.02 AND rt < 0.98 AND rs > 0.1 AND rs < 0.9, false) AS crossed, round(x0 + dx * ta, 4) AS x, round(y0 + dy * ta, 4) AS y, round(ta, 4) AS ta, round((x0 + dx * ta - ox) * ex + (y0 + dy * ta - oy) * ey, 4) AS tb FROM r""",
    "wall_order": f"""WITH {_WALL}, k AS (SELECT *, CASE WHEN -dy < -1e-9 OR (abs(dy) <= 1e-9 AND dx < 0) THEN -1 ELSE 1 END AS s, id % 7 AS inl, round(length, 1) AS len, round(seen, 1) AS rms FROM w),
g AS (SELECT *, [round(-s * dy, 8), round(s * dx, 8), round(-dy * x0 + dx * y0, 8), round(x0, 8), round(y0, 8), round(x1, 8), round(y1, 8)] AS key FROM k)
SELECT label, id, row_number() OVER (PARTITION BY label ORDER BY len DESC, inl DESC, key) AS place, row_number() OVER (PARTITION BY label ORDER BY inl DESC, len DESC, rms, key) AS fitted FROM g""",
    "plane_triples": f"""WITH e AS ({_E}), c AS (SELECT *, (e4-e1)*(e8-e2) - (e5-e2)*(e7-e1) AS cx, (e5-e2)*(e6-e0) - (e3-e0)*(e8-e2) AS cy, (e3-e0)*(e7-e1) - (e4-e1)*(e6-e0) AS cz FROM e),
n AS (SELECT *, sqrt(cx*cx + cy*cy + cz*cz) AS n FROM c), u AS (SELECT *, CASE WHEN CASE WHEN abs(cx) >= abs(cy) AND abs(cx) >= abs(cz) THEN cx WHEN abs(cy) >= abs(cz) THEN cy ELSE cz END < 0 THEN -1 ELSE 1 END / n AS k FROM n WHERE n > 1e-8),
v AS (SELECT id, e0, e1, e2, k * cx AS nx, k * cy AS ny, k * cz AS nz FROM u),
f AS (SELECT *, CASE WHEN abs(nz) >= cos(radians(25)) AND e2 < -0.1 THEN 'floor' WHEN abs(nz) >= cos(radians(25)) AND e2 * 10 >= 1.8 THEN 'ceiling' WHEN abs(nz) < cos(radians(25)) AND abs(nz) <= sin(radians(25)) THEN 'wall' ELSE 'clutter' END AS kind FROM v)
SELECT id, round(nx, 5) AS nx, round(ny, 5) AS ny, round(nz, 5) AS nz, round(nx*e0 + ny*e1 + nz*e2, 5) AS "offset", kind, kind = 'clutter' AS quarantined, e2 * 10 > -0.65 AND e2 * 10 < CASE WHEN id % 2 = 0 THEN 1.65 ELSE 0.9 END AND abs(nz) < 0.35 AS band FROM f""",
    "room_heights": f"""WITH e AS ({_E}), n AS (SELECT *, sqrt(e0*e0 + e1*e1 + 1) AS nf, sqrt(e3*e3 + e4*e4 + 16*e5*e5) AS nc FROM e),
h AS (SELECT *, CASE WHEN abs(1 / nf) > 0.1 THEN (0.1 - (e0*e6 + e1*e7) / nf) / (1 / nf) END AS fl, 4 * e5 / nc AS uc FROM n),
r AS (SELECT *, CASE WHEN abs(uc) > 0.1 THEN (10 * e5 - (e3*e6 + e4*e7 + 4*e5*fl) / nc) / uc END AS h FROM h)
SELECT id, CASE WHEN h > 0 THEN round(h, 5) END AS height, round(e6, 6) AS u, round(e7, 6) AS v FROM r""",
    "offset_rooms": f"""WITH e AS ({_E}) SELECT id, round((abs(e0) * 10 + 1 + abs(e3) + abs(e5)) * (abs(e1) * 10 + 1 + abs(e2) + abs(e4)), 5) AS area, round(-abs(e5), 5) AS x0, round(abs(e1) * 10 + 1 + abs(e4), 5) AS y2 FROM e""",
    "record_fields": f"""WITH x AS (SELECT *, {_LIST(_WORDS)}[(event_id % 12 + 1)::INT] AS word, ['door', 'door', 'window', 'pass-through', NULL, 'pass-through', NULL, NULL, NULL, 'window', NULL, 'door'][(event_id % 12 + 1)::INT] AS kind,
 [true, false, false, true, true, true, false, false, true, false, false, true][(event_id % 12 + 1)::INT] AS truth, (event_id % 3 - 1)::DOUBLE AS size,
 CASE WHEN event_id % 2 = 0 THEN 1000 ELSE 1 END AS k, value / 1000 AS bx FROM events)
SELECT event_id, kind, truth, CASE WHEN event_id % 5 IN (0, 1) THEN -1 ELSE round(value, 6) END AS number, CASE WHEN size <> 0 THEN round(least(value, value + size), 6) END AS low, CASE WHEN size <> 0 THEN round(greatest(value, value + size), 6) END AS high,
 CASE WHEN bx <> 0.1 THEN round(least(bx, 0.1) * CASE WHEN k = 1 AND least(bx, 0.1) >= 0 AND greatest(bx, 0.5) > 1 THEN 0.2 ELSE 200.0 / k END, 6) END AS b0,
 CASE WHEN bx <> 0.1 THEN round(0.2 * CASE WHEN k = 1 AND least(bx, 0.1) >= 0 AND greatest(bx, 0.5) > 1 THEN 0.1 ELSE 100.0 / k END, 6) END AS b1,
 CASE WHEN bx <> 0.1 THEN round(greatest(bx, 0.1) * CASE WHEN k = 1 AND least(bx, 0.1) >= 0 AND greatest(bx, 0.5) > 1 THEN 0.2 ELSE 200.0 / k END, 6) END AS b2,
 CASE WHEN bx <> 0.1 THEN round(0.5 * CASE WHEN k = 1 AND least(bx, 0.1) >= 0 AND greatest(bx, 0.5) > 1 THEN 0.1 ELSE 100.0 / k END, 6) END AS b3,
 CASE event_id % 3 WHEN 0 THEN 3 WHEN 1 THEN event_id % 9 END::INT AS wall, 'rgb' AS source, CASE event_id % 5 WHEN 0 THEN 0 WHEN 1 THEN NULL ELSE round(greatest(value, 0), 6) END AS sigma FROM x""",
    "measurement_records": f"""{_EV}, c AS (SELECT *, least(1, greatest(0, 0.28::DOUBLE * least(1, sqrt(points) / sqrt(500)) + 0.18::DOUBLE * coalesce(least(1, density / 80), 0.65) + 0.24::DOUBLE * exp(-rms / 0.045) + 0.09::DOUBLE * CASE pose WHEN 'unknown' THEN 0.55 WHEN 'arkit_refined' THEN 0.95 ELSE 0.7 END
 + 0.03::DOUBLE * exp(-pose_sigma / 0.05) + 0.1::DOUBLE * CASE depth WHEN 'tls_lidar' THEN 0.95 WHEN 'unknown' THEN 0.6 ELSE 0.5 END + 0.08::DOUBLE * CASE WHEN calibrated THEN 1 ELSE 0.78 END)) AS confidence,
 greatest(rms / greatest(sqrt(points), 1), 0.002) AS own FROM v),
t AS (SELECT *, 1.96::DOUBLE * sqrt(own * own + pose_sigma * pose_sigma) * CASE WHEN density < 80 THEN 1 + least(1.5, (80 - density) / 80) ELSE 1 END * CASE WHEN pose IN ('unknown', 'raw') THEN 1.25 ELSE 1 END * CASE WHEN depth IN ('unknown', 'monocular') THEN 3 ELSE 1 END * 1.2 * CASE WHEN calibrated THEN 1 ELSE 1.1 END AS tol,
 sqrt(pow(0.04::DOUBLE / sqrt(12) * 2, 2) + pow(v0 / 100, 2) + pow(0.03::DOUBLE * (1 - (id % 10) / 10.0::DOUBLE), 2)) * 1.645::DOUBLE * CASE WHEN id % 2 = 0 THEN 1 ELSE 3 END AS half FROM c)
SELECT id, round(area, 7) AS value, round(tol, 6) AS tolerance, round(confidence, 6) AS confidence, round(half, 4) AS half_width,
 array_to_string(list_sort(list_filter([CASE WHEN points < 100 THEN 'weak_support' END, CASE WHEN density < 20 THEN 'weak_support_density' END, CASE WHEN rms > 0.04 THEN 'high_tls_residual' END, CASE WHEN pose_sigma > 0.05 THEN 'high_pose_uncertainty' END, CASE WHEN pose IN ('unknown', 'raw') THEN 'pose_uncertain' END,
 CASE WHEN depth IN ('unknown', 'monocular') THEN 'depth_uncertain' END, CASE WHEN NOT calibrated THEN 'uncalibrated' END, CASE WHEN id % 3 = 0 THEN 'inferred_geometry' END, CASE WHEN confidence < 0.6 THEN 'manual_review' END], lambda x: x IS NOT NULL)), '+') AS flags FROM t""",
    "evidence_by_room": f"{_EV} SELECT room_id, sum(points) AS points, round(sqrt(avg(rms * rms)), 6) AS rms, round(avg(density), 6) AS density, round(max(pose_sigma), 6) AS pose_sigma FROM v GROUP BY room_id",
    "scale_checks": f"""{_R}, x AS (SELECT id, ['user', 'user', 'door', 'tape'][(id % 4 + 1)::INT] AS kind, CASE WHEN id % 5 > 0 THEN width - 0.4 END AS o, height_extent + 0.1 AS k, CASE WHEN id % 3 = 0 THEN 0.05 END AS tl FROM regions),
y AS (SELECT *, coalesce(o > 0 AND k > 0, false) AND kind <> 'door' AS ok FROM x)
SELECT id, kind, CASE WHEN kind = 'door' THEN 'advisory' WHEN ok THEN 'validated' ELSE 'unmeasured' END AS status, CASE WHEN ok THEN round(k / o, 5) END AS factor, CASE WHEN ok THEN round(greatest(coalesce(tl, 0.01 * k), 0.001), 6) END AS tolerance,
 CASE WHEN kind = 'door' THEN 0.2 WHEN ok THEN round(greatest(0.9, least(1, greatest(0, 1 - abs(o * (k / o) - k) / greatest(coalesce(tl, 0.01 * k), 0.001)))), 6) ELSE 0 END AS confidence FROM y""",
    "plane_candidates": f"""{_R}, x AS (SELECT id, v1 AS h, id % 300 AS n, area / 50 AS rms, v0 AS q, floor(area * 1000) / 1e5 AS sg FROM regions),
y AS (SELECT *, least(greatest(greatest(0.04, 2.5 * sg + 0.01), 0.04), 0.12) AS lim, least(1, greatest(0, 0.45::DOUBLE * least(1, n / 100.0::DOUBLE) + 0.35::DOUBLE * exp(-rms / 0.04) + 0.2::DOUBLE * least(1, greatest(0, q)))) AS base FROM x),
z AS (SELECT *, rms <= 0.04 AND n >= 100 AND q >= 0.35 AS high, n >= 100 AS seen FROM y)
SELECT id, CASE WHEN seen THEN round(h, 6) END AS height, round(CASE WHEN high THEN base WHEN seen THEN CASE WHEN rms <= lim AND q >= 0.35 THEN 0.65 ELSE 0.35 END * base ELSE 0 END, 6) AS confidence, CASE WHEN high THEN 'high_confidence' WHEN seen THEN 'low_confidence' ELSE 'rejected' END AS status,
 round(least(1, n / 400.0::DOUBLE), 6) AS support, round(lim, 6) AS adaptive_limit,
 array_to_string(list_filter([CASE WHEN n < 100 THEN 'support_below_threshold' END, CASE WHEN q < 0.35 THEN 'candidate_quality_below_threshold' END, CASE WHEN rms > 0.04 THEN 'residual_above_strict_threshold' END, CASE WHEN rms > lim THEN 'residual_above_adaptive_threshold' END], lambda x: x IS NOT NULL), '+') AS reasons FROM z""",
    "refinement_gate": f"""{_R}, x AS (SELECT id, list_filter([CASE WHEN area / 2 > 0.75 THEN 'maximum correction' END, CASE WHEN id % 3 = 0 THEN 'no loop-closure' END, CASE WHEN v0 * 2 >= v1 - 1e-6 THEN 'pose-graph objective' END,
 CASE WHEN id % 4 = 0 THEN 'loop residual' WHEN v0 * 1.5 >= v1 - 1e-4 THEN 'loop residual' END, CASE WHEN height_extent > width + 0.05 THEN 'loop closure' END], lambda x: x IS NOT NULL) AS l FROM regions)
SELECT id, len(l)::INT AS n, array_to_string(l, '+') AS reasons FROM x""",
    "region_texts": f"""{_R} SELECT id, surface_key || printf(': %.2f m2 ', (id % 40) / 4.0::DOUBLE) || CASE WHEN damage_class = 'combined' THEN combined_classes[1] || '+' || combined_classes[2] || ' combined' WHEN damage_class = 'water' AND water_category > 0 THEN 'Cat ' || water_category || ' water'
 WHEN subtype IS NOT NULL THEN damage_class || ' (' || subtype || ')' ELSE damage_class END || ', ' || CASE WHEN id % 3 = 0 THEN printf('lower %.2f m affected', (id % 9) / 4.0::DOUBLE) ELSE printf('between %.2f and %.2f m', (id % 3) / 4.0::DOUBLE, (id % 9) / 4.0::DOUBLE) END AS text FROM regions""",
    "gate_table": f"""{_CMP}, g(gate, kind, flat, share, target) AS (VALUES ('wall_length', 'wall_length', 0.02::DOUBLE, 0.01::DOUBLE, 0.9::DOUBLE), ('wall_length_stretch', 'wall_length', 0, 0.005, 0.9), ('ceiling_height', 'ceiling_height', 0.015, 0, 1), ('floor_area', 'floor_area', 0, 0.02, 1), ('opening_width', 'opening_width', 0.02, 0, 0.85), ('damage_area', 'damage_area', 0, 0.1, 1)),
p AS (SELECT gate, target, count(*) FILTER (e <= greatest(flat, share * truth)) AS passing, count(*) AS total FROM e JOIN g ON g.kind = e.kind GROUP BY gate, target)
SELECT gate, passing, total, round(passing / total::DOUBLE, 4) AS fraction, target, passing / total::DOUBLE >= target AS passed FROM p""",
    "interval_report": f"""{_CMP} SELECT kind, count(*) AS n, round(median(e) * 1000, 2) AS median_error_mm, round(quantile_cont(e, 0.9) * 1000, 2) AS p90_error_mm, round(max(e) * 1000, 2) AS max_error_mm, round(avg((e <= half_width)::INT), 4) AS observed, abs(avg((e <= half_width)::INT) - 0.9) <= 0.1 AS calibrated FROM e GROUP BY kind""",
    "water_scores": f"""{_R}, b AS (SELECT surface_key, water_category AS c, water_class AS l, row_number() OVER (PARTITION BY surface_key ORDER BY area DESC, id) AS k FROM regions WHERE damage_class IN ('water', 'combined')),
a AS (SELECT surface_key, min(id) % 4 AS c, min(id) % 3 AS l FROM regions GROUP BY surface_key),
x AS (SELECT (a.c < 1 OR coalesce(b.c = a.c, false)) AND (a.l < 2 OR coalesce(b.l = a.l, false)) AS ok FROM a LEFT JOIN b ON b.surface_key = a.surface_key AND b.k = 1 WHERE a.c >= 1 OR a.l >= 2)
SELECT count(*) FILTER (ok) AS correct, count(*) AS checked, round(avg(ok::INT), 4) AS fraction, avg(ok::INT) >= 0.7 AS passed FROM x""",
    "room_neighbours": "SELECT DISTINCT a.l_suppkey AS scene, a.l_linenumber AS room, b.l_linenumber AS other FROM lineitem a JOIN lineitem b ON a.l_suppkey = b.l_suppkey AND a.l_partkey = b.l_partkey WHERE a.l_linenumber <> b.l_linenumber",
    "strided_frames": "SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS k FROM events) WHERE k % 3 = 0",
    "frame_decisions": f"""{_FR} SELECT "index", decision, reason, CASE WHEN lost THEN 'unknown' WHEN flat THEN 'pose' WHEN decision = 'dense' OR (decision = 'rejected' AND why IS NOT NULL) THEN 'metric3d_v2_scale_shift_lidar_residual' ELSE 'raw_lidar' END AS source, fallback FROM x""",
    "frame_report": f"""{_FR} SELECT capture, count(*) AS selected_frames, count(*) FILTER (k < 2) AS densified_frames, count(*) FILTER (k = 0) AS qc_approved_dense_frames, count(*) FILTER (decision <> 'rejected') AS fused_frames, count(*) FILTER (decision = 'dense') AS fused_dense_frames,
 count(*) FILTER (decision = 'raw') AS fused_raw_frames, count(*) FILTER (decision = 'rejected') AS rejected_frames, count(*) FILTER (fallback IS NOT NULL) AS fallback_frames, count(*) FILTER (decision = 'rejected') + count(*) FILTER (k = 1) AS rejected_frames_total FROM x GROUP BY capture""",
}
