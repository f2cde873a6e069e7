"""Queries of measured walls and rooms, laid out by the embeddings, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import scene_measures
from ..operators.graphs import checkpointed
from .rooms import _BOXES, _boxes


def _evidence(rms):
    return F.struct(rms.alias("rms"), F.lit(600).cast("long").alias("points"), F.lit(100.0).alias("density"), F.lit("slam_refined").alias("pose"), F.lit("lidar").alias("depth"), F.lit("calibrated").alias("calibration"), F.lit(0.0).alias("pose_sigma"))


def _records(s, d):
    """Four walls a room, but three of every third; every fifth wall has no ends, every seventh no height, some have meeting points."""
    b = _boxes(s, d)
    wall = lambda k, n, o, p, q: F.struct(F.lit(k).alias("k"), F.lit(float(n[0])).alias("nx"), F.lit(float(n[1])).alias("ny"), F.col(o).alias("offset"), *[F.col(c).alias(a) for c, a in zip((*p, *q), ("x0", "y0", "x1", "y1"), strict=True)])
    four = F.array(wall(0, (0, 1), "y0", ("x0", "y0"), ("x1", "y0")), wall(1, (1, 0), "x1", ("x1", "y0"), ("x1", "y1")), wall(2, (0, 1), "y1", ("x1", "y1"), ("x0", "y1")), wall(3, (1, 0), "x0", ("x0", "y1"), ("x0", "y0")))
    w = b.select("scene", "id", F.explode(four).alias("w")).select("scene", (F.col("id") * 4 + F.col("w.k")).alias("wall"), "id", "w.*").where("id % 3 > 0 or k > 0")
    meetings = w.where("wall % 2 = 0").select("scene", F.col("wall").alias("a"), F.lit(None).cast("long").alias("b"), F.explode(F.array(*[F.struct(F.col(f"x{n}").alias("x"), F.col(f"y{n}").alias("y")) for n in (0, 1)])).alias("p")).select("scene", "a", "b", "p.x", "p.y")
    ended = [F.when(F.pmod("wall", F.lit(5)) > 0, F.col(c)).alias(c) for c in ("x0", "y0", "x1", "y1")]
    rms = 0.001 + F.pmod("wall", F.lit(7)) * 0.001
    w = w.select("scene", "wall", "nx", "ny", "offset", *ended, F.when(F.pmod("wall", F.lit(7)) > 0, 0.1).alias("low"), F.lit(2.4).alias("high"), _evidence(rms).alias("e"), F.lit(True).alias("observed"), (F.pmod("wall", F.lit(11)) / 50.0).alias("inferred"))
    return scene_measures.wall_records(w, meetings, "scene")


def measured_walls(s, d):
    """Length, height and thickness of every wall, with their tolerances and flags."""
    x = scene_measures.measured_walls(_records(s, d), "scene")
    named = [c for n in ("length", "extent", "thickness") for c in (F.round(f"{n}.value", 6).alias(n), F.round(f"{n}.tolerance", 7).alias(f"{n}_tolerance"), F.concat_ws("+", f"{n}.flags").alias(f"{n}_flags"))]
    return x.select("scene", "wall", *named, "opposing", "geometry_source")


def measured_rooms(s, d):
    """The areas of every room inside, to the centre lines and to the outside of its walls."""
    r = checkpointed(_records(s, d))
    b = _boxes(s, d)
    status = F.when(F.pmod("id", F.lit(11)) == 0, "rejected")
    source = F.when(F.pmod("id", F.lit(13)) == 0, "Raster outline")
    rooms = b.select("scene", F.col("id").alias("room"), F.when(F.pmod("id", F.lit(17)) > 0, F.col("polygon")).alias("polygon"), status.alias("status"), source.alias("source"), F.when(F.pmod("id", F.lit(19)) == 0, 0.4).alias("confidence"), F.array(*[F.col("id") * 4 + k for k in range(4)]).alias("walls"), _evidence(F.lit(0.005)).alias("e"))
    x = scene_measures.measured_rooms(rooms, r, checkpointed(scene_measures.measured_walls(r, "scene")), "scene")
    named = [c for n in ("interior", "centreline", "outer") for c in (F.round(f"{n}.value", 6).alias(n), F.round(f"{n}.tolerance", 6).alias(f"{n}_tolerance"), F.col(f"{n}.status").alias(f"{n}_status"))]
    return x.select("scene", "room", *named, "boundary_source")


_RECORDS = f"""WITH {_BOXES}, s AS (SELECT scene, id, 0 AS k, 0.0::DOUBLE AS nx, y0 AS o, x0, y0, x1, y0 AS y1 FROM b UNION ALL SELECT scene, id, 1, 1, x1, x1, y0, x1, y1 FROM b UNION ALL SELECT scene, id, 2, 0, y1, x1, y1, x0, y1 FROM b UNION ALL SELECT scene, id, 3, 1, x0, x0, y1, x0, y0 FROM b),
w AS MATERIALIZED (SELECT scene, id, k, id * 4 + k AS wall, nx, o, CASE WHEN nx = 0 THEN least(x0, x1) ELSE least(y0, y1) END AS lo, CASE WHEN nx = 0 THEN greatest(x0, x1) ELSE greatest(y0, y1) END AS hi, 0.001::DOUBLE + ((id * 4 + k) % 7) * 0.001::DOUBLE AS rms,
 CASE WHEN (id * 4 + k) % 2 = 0 THEN 'supplied_plane_intersections' WHEN (id * 4 + k) % 5 > 0 THEN 'phase1_plane_endpoints' ELSE 'unmeasured' END AS src FROM s WHERE id % 3 > 0 OR k > 0),
f AS (SELECT * FROM w WHERE wall % 11 / 50.0 <= 0.15 AND src <> 'unmeasured'),
p AS (SELECT a.scene, a.wall AS p, b.wall AS q, abs(a.o - b.o) AS gap, sqrt(a.rms * a.rms + b.rms * b.rms) / sqrt(2) AS rms FROM f a JOIN f b ON a.scene = b.scene AND a.nx = b.nx AND a.wall < b.wall WHERE abs(a.o - b.o) BETWEEN 0.025 AND 0.8 AND least(a.hi, b.hi) - greatest(a.lo, b.lo) >= greatest(0.25, 0.25 * least(a.hi - a.lo, b.hi - b.lo))),
t AS (SELECT * FROM (SELECT * FROM p UNION ALL SELECT scene, q, p, gap, rms FROM p) QUALIFY row_number() OVER (PARTITION BY p ORDER BY gap, q) = 1),
m AS MATERIALIZED (SELECT w.*, q AS opposing, gap, CASE WHEN gap IS NOT NULL THEN 1.645::DOUBLE * greatest(t.rms, 0.002) END AS gtol FROM w LEFT JOIN t ON t.p = w.wall)"""

ORACLES = {
    "measured_walls": _RECORDS + """ SELECT scene, wall, CASE WHEN src <> 'unmeasured' THEN round(hi - lo, 6) END AS length, round(CASE src WHEN 'supplied_plane_intersections' THEN 1.645::DOUBLE WHEN 'phase1_plane_endpoints' THEN 1.645::DOUBLE * 1.75 END * greatest(rms, 0.002), 7) AS length_tolerance,
CASE src WHEN 'supplied_plane_intersections' THEN '' WHEN 'phase1_plane_endpoints' THEN 'inferred_geometry+open_ended_geometry' ELSE 'wall_length_unmeasured+plane_extent_missing+manual_review' END AS length_flags,
CASE WHEN wall % 7 > 0 THEN round(2.3::DOUBLE, 6) END AS extent, CASE WHEN wall % 7 > 0 THEN round(1.645::DOUBLE * greatest(rms, 0.002), 7) END AS extent_tolerance, CASE WHEN wall % 7 > 0 THEN '' ELSE 'vertical_extent_unmeasured+manual_review' END AS extent_flags,
round(gap, 6) AS thickness, round(gtol, 7) AS thickness_tolerance, CASE WHEN gap IS NULL THEN 'opposing_face_not_observed+wall_thickness_unmeasured+manual_review' ELSE '' END AS thickness_flags, opposing, src AS geometry_source FROM m""",
    "measured_rooms": _RECORDS + """, g AS (SELECT id, count(*) AS n, sum(rms * rms) AS sq, avg(coalesce(gtol, 0)) AS spread, bool_or(gap IS NULL) AS guessed, max(CASE WHEN k = 0 THEN coalesce(gap, 0.15) / 2 END) AS d0, max(CASE WHEN k = 1 THEN coalesce(gap, 0.15) / 2 END) AS d1, max(CASE WHEN k = 2 THEN coalesce(gap, 0.15) / 2 END) AS d2, max(CASE WHEN k = 3 THEN coalesce(gap, 0.15) / 2 END) AS d3 FROM m GROUP BY id),
r AS (SELECT b.*, x1 - x0 AS w, y1 - y0 AS h, n, spread, guessed OR n < 4 AS assumed, CASE WHEN n < 4 THEN 0.15 ELSE d1 + d3 END::DOUBLE AS dx, CASE WHEN n < 4 THEN 0.15 ELSE d0 + d2 END::DOUBLE AS dy, greatest(sqrt((sq + 0.000025::DOUBLE) / (n + 1)), 0.002) AS sig,
 CASE WHEN b.id % 11 = 0 THEN 'unmeasured' WHEN b.id % 13 = 0 THEN 'raster_rejected' WHEN b.id % 19 = 0 THEN 'low_confidence' WHEN b.id % 17 = 0 THEN 'unmeasured' END AS why FROM b JOIN g ON g.id = b.id)
SELECT scene, id AS room, CASE WHEN why IS NULL THEN round(w * h, 6) END AS interior, CASE WHEN why IS NULL THEN round(1.645::DOUBLE * greatest((w + h) * sig, 0.002), 6) END AS interior_tolerance, CASE WHEN why IS NULL THEN 'measured' ELSE 'unmeasured' END AS interior_status,
CASE WHEN why IS NULL THEN round((w + dx) * (h + dy), 6) END AS centreline, CASE WHEN why IS NULL THEN round(1.645::DOUBLE * greatest((w + h) * sig + (w + h) * spread, 0.002), 6) END AS centreline_tolerance, CASE WHEN why IS NOT NULL THEN 'unmeasured' WHEN assumed THEN 'estimated' ELSE 'measured' END AS centreline_status,
CASE WHEN why IS NULL THEN round((w + 2 * dx) * (h + 2 * dy), 6) END AS outer, CASE WHEN why IS NULL THEN round(1.645::DOUBLE * greatest((w + h) * sig + 2 * (w + h) * spread, 0.002), 6) END AS outer_tolerance, CASE WHEN why IS NOT NULL THEN 'unmeasured' WHEN assumed THEN 'estimated' ELSE 'measured' END AS outer_status, coalesce(why, 'supplied_bounded_face') AS boundary_source FROM r""".replace("AS outer,", 'AS "outer",'),
}

QUERIES = {f.__name__: f for f in (measured_walls, measured_rooms)}
