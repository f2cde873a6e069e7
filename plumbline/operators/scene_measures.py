"""Measurements of a scene's walls and rooms, with what they rest on; what was not seen stays unmeasured.

Evidence e is a struct (rms, points, density, pose, depth, calibration, pose_sigma).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.frames import offset_polygon
from ..functions.geometry import signed_area
from ..functions.measures import measurement, unmeasured

#: Reasons and bases: fixed texts.
NO_EXTENT = ("finite wall extent/intersections not supplied by TLS geometry stage", "wall_length_unmeasured", "plane_extent_missing")
NO_HEIGHT = ("wall inlier vertical extent unavailable from TLS support", "vertical_extent_unmeasured")
NO_FACE = ("opposing observed TLS wall face not found", "opposing_face_not_observed", "wall_thickness_unmeasured")
NO_ROOM = ("bounded room face not supplied by TLS geometry/closure stage", "room_boundary_unmeasured", "geometry_not_supplied")
BY_MEETINGS = "distance between supplied finite intersections of observed TLS wall planes"
BY_ENDS = "distance between Phase 1 observed TLS wall endpoints; structured intersection extent pending"
HEIGHT = "observed inlier vertical extent of the TLS wall plane"
FACES = "separation of two actually observed opposing TLS wall faces"
CENTRE = "interior face offset outward by one-half of each wall thickness"
OUTER = "interior face offset outward by one full wall thickness"


def indexed_meetings(meetings: DataFrame, scene: str) -> DataFrame:
    """(scene, wall, x, y): each meeting point of two planes under both of them; meetings(scene, a, b, x, y), finite ones only."""
    finite = " and ".join(f"{c} is not null and not isnan({c}) and abs({c}) < double('infinity')" for c in "xy")
    return meetings.where(finite).select(scene, F.explode(F.array("a", "b")).alias("wall"), "x", "y").where("wall is not null")


def wall_records(walls: DataFrame, meetings: DataFrame, scene: str) -> DataFrame:
    """walls with their ends: the outermost of two or more meeting points along the wall, else their own ends, else none.

    walls(scene, wall, nx, ny, offset, x0, y0, x1, y1, low, high, e, observed, inferred), ends and heights may be null.
    Adds length and geometry_source; the density of the evidence, where it is null, comes from points, length and height.
    """
    m = indexed_meetings(meetings, scene).join(walls.select(scene, "wall", "nx", "ny"), [scene, "wall"])
    at = F.col("y") * F.col("nx") - F.col("x") * F.col("ny")
    m = m.groupBy(scene, "wall").agg(F.count("*").alias("met"), F.min_by(F.struct("x", "y"), at).alias("p"), F.max_by(F.struct("x", "y"), at).alias("q")).where("met >= 2")
    w = walls.join(m, [scene, "wall"], "left")
    own = F.hypot(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")) > 1e-8
    source = F.when(F.col("met").isNotNull(), "supplied_plane_intersections").when(F.coalesce(own, F.lit(False)), "phase1_plane_endpoints").otherwise("unmeasured")
    w = w.withColumn("geometry_source", source)
    end = lambda c, p, n: F.when(F.col("met").isNotNull(), F.col(f"{p}.{c}")).when(F.col("geometry_source") == "phase1_plane_endpoints", F.col(f"{c}{n}")).alias(f"{c}{n}")
    keep = [c for c in walls.columns if c not in ("x0", "y0", "x1", "y1", "e")]
    w = w.select(*keep, "geometry_source", "e", *[end(c, p, n) for p, n in (("p", 0), ("q", 1)) for c in "xy"])
    w = w.withColumn("length", F.coalesce(F.hypot(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")), F.lit(0.0)))
    tall = F.coalesce(F.abs(F.col("high") - F.col("low")), F.lit(0.0))
    dense = F.when((F.col("length") > 1e-6) & (tall > 1e-6), F.col("e.points") / F.greatest(F.col("length") * tall, F.lit(1e-6)))
    return w.withColumn("e", F.col("e").withField("density", F.coalesce(F.col("e.density"), dense)))


def facing_walls(records: DataFrame, scene: str, low: float = 0.025, high: float = 0.80) -> DataFrame:
    """(scene, wall, other, thickness, e): for each seen wall the nearest parallel one that is low to high away and runs beside it.

    Both must be seen and not much inferred, and share 0.25 m and a quarter of the shorter one.  Offsets are cut
    into bands of `high`, of which one side looks into three.
    """
    r = records.where("observed and inferred <= 0.15 and length > 0").withColumn("band", F.floor(F.col("offset") / high))
    cols = ("wall", "nx", "ny", "offset", "x0", "y0", "x1", "y1", "length", "e")
    a = r.select(scene, "band", *[F.col(c).alias(f"a_{c}") for c in cols])
    b = r.withColumn("band", F.explode(F.array(*[F.col("band") + k for k in (-1, 0, 1)]))).select(scene, "band", *[F.col(c).alias(f"b_{c}") for c in cols])
    x = a.join(b, [scene, "band"]).where("a_wall < b_wall and abs(a_nx * b_nx + a_ny * b_ny) >= 0.98").withColumn("gap", F.abs(F.col("a_offset") - F.col("b_offset"))).where(F.col("gap").between(low, high))
    dx, dy = ((F.col(f"a_{c}1") - F.col(f"a_{c}0")) / F.col("a_length") for c in "xy")
    along = lambda n: (F.col(f"b_x{n}") - F.col("a_x0")) * dx + (F.col(f"b_y{n}") - F.col("a_y0")) * dy
    shared = F.least(F.col("a_length"), F.greatest(along(0), along(1))) - F.greatest(F.lit(0.0), F.least(along(0), along(1)))
    x = x.where(shared >= F.greatest(F.lit(0.25), 0.25 * F.least("a_length", "b_length")))
    e = F.struct(
        (F.hypot("a_e.rms", "b_e.rms") / F.sqrt(F.lit(2.0))).alias("rms"), (F.col("a_e.points") + F.col("b_e.points")).alias("points"), ((F.col("a_e.density") + F.col("b_e.density")) / 2).alias("density"),
        *[F.col(f"a_e.{c}").alias(c) for c in ("pose", "depth", "calibration")], F.lit(0.0).alias("pose_sigma"),
    )
    x = x.select(scene, F.col("a_wall").alias("p"), F.col("b_wall").alias("q"), "gap", e.alias("e"))
    both = x.unionByName(x.select(scene, F.col("q").alias("p"), F.col("p").alias("q"), "gap", "e"))
    return both.groupBy(scene, F.col("p").alias("wall")).agg(F.min_by(F.struct("q", "gap", "e"), F.struct("gap", "q")).alias("m")).select(scene, "wall", F.col("m.q").alias("other"), F.col("m.gap").alias("thickness"), "m.e")


def _flagged(m: Column, name: str) -> Column:
    return m.withField("flags", F.array_sort(F.array_union(m["flags"], F.array(F.lit(name)))))


def _sure(e: Column) -> Column:
    return F.greatest(e["rms"], F.lit(0.002))


def measured_walls(records: DataFrame, scene: str) -> DataFrame:
    """(scene, wall, length, extent, thickness, opposing, geometry_source): the measurements of each wall; records as wall_records gives them."""
    x = records.join(facing_walls(records, scene).select(scene, "wall", "other", F.col("thickness").alias("gap"), F.col("e").alias("fe")), [scene, "wall"], "left")
    e = F.col("e")
    met = F.col("geometry_source") == "supplied_plane_intersections"
    by_meetings = measurement(F.col("length"), e, BY_MEETINGS, sigma=_sure(e))
    by_ends = _flagged(measurement(F.col("length"), e, BY_ENDS, sigma=_sure(e) * 1.75, inferred=True), "open_ended_geometry")
    length = F.when(F.col("length") <= 1e-8, unmeasured(*NO_EXTENT)).when(met, by_meetings).otherwise(by_ends)
    tall = F.abs(F.col("high") - F.col("low"))
    extent = F.when(F.coalesce(tall > 0, F.lit(False)), measurement(tall, e, HEIGHT, sigma=_sure(e))).otherwise(unmeasured(*NO_HEIGHT))
    thick = F.when(F.col("gap").isNotNull(), measurement(F.col("gap"), F.col("fe"), FACES, sigma=_sure(F.col("fe")))).otherwise(unmeasured(*NO_FACE))
    return x.select(scene, "wall", length.alias("length"), extent.alias("extent"), thick.alias("thickness"), F.col("other").alias("opposing"), "geometry_source")


def room_boundary(polygon: Column, status: Column, source: Column, confidence: Column) -> Column:
    """(polygon, source): a room's boundary if it may be measured, else null and why not.

    A stated status of anything but a good one, outlines of rasters, a confidence below 0.5 and polygons that are no area rule it out.
    """
    name = F.replace(F.lower(F.trim(F.coalesce(source, F.lit("")))), F.lit(" "), F.lit("_"))
    bad = F.coalesce(F.lower(F.trim(status)).isin("unmeasured", "invalid", "rejected", "unknown", "low_confidence"), F.lit(False))
    whole = F.coalesce((F.size(polygon) >= 3) & ~F.exists(polygon, lambda p: p["x"].isNull() | p["y"].isNull() | F.isnan(p["x"]) | F.isnan(p["y"]) | (F.abs(p["x"]) == float("inf")) | (F.abs(p["y"]) == float("inf"))), F.lit(False))
    why = F.when(bad, "unmeasured").when(name.rlike("raster|occupancy|grid|flood|watershed"), "raster_rejected").when(F.coalesce(confidence < 0.5, F.lit(False)), "low_confidence").when(polygon.isNull(), "unmeasured").when(~whole, "invalid").when(F.abs(signed_area(polygon)) <= 1e-8, "invalid")
    return F.struct(F.when(why.isNull(), polygon).alias("polygon"), F.coalesce(why, F.when(name == "", "supplied_bounded_face").otherwise(name)).alias("source"))


def measured_rooms(rooms: DataFrame, records: DataFrame, walls: DataFrame, scene: str, default: float = 0.15) -> DataFrame:
    """(scene, room, interior, centreline, outer, boundary_source, thicknesses): the areas of each room.

    rooms(scene, room, polygon, status, source, confidence, walls, e), walls the numbers of its walls; records as wall_records
    gives them, walls as measured_walls does.  Each side of the boundary goes with the nearest parallel one of its room's walls.  The
    polygon moved out by half of each wall's thickness is the centre line's, by all of it the outer one; where a side has
    no wall all take half of `default`, where a wall has no measured thickness that wall does, and the area is estimated.
    """
    b = rooms.withColumn("b", room_boundary(F.col("polygon"), F.col("status"), F.col("source"), F.col("confidence")))
    good = b.where("b.polygon is not null").select(scene, "room", F.col("b.polygon").alias("polygon"), "walls", "e")
    after = F.concat(F.slice("polygon", 2, F.size("polygon") - 1), F.slice("polygon", 1, 1))
    sides = good.select(scene, "room", "walls", F.posexplode(F.arrays_zip(F.col("polygon").alias("p"), after.alias("q"))).alias("side", "s"))
    dx, dy = F.col("s.q.x") - F.col("s.p.x"), F.col("s.q.y") - F.col("s.p.y")
    sides = sides.select(scene, "room", "side", F.explode("walls").alias("wall"), dx.alias("dx"), dy.alias("dy"), ((F.col("s.p.x") + F.col("s.q.x")) / 2).alias("mx"), ((F.col("s.p.y") + F.col("s.q.y")) / 2).alias("my"), F.hypot(dx, dy).alias("size"))
    known = records.select(scene, "wall", "nx", "ny", "offset", F.col("length").alias("long"), F.col("e").alias("we")).join(walls.select(scene, "wall", F.col("thickness.value").alias("thick"), F.col("thickness.tolerance").alias("tolerance")), [scene, "wall"])
    x = sides.where("size > 1e-9").join(known, [scene, "wall"])
    away = F.abs(F.col("mx") * F.col("nx") + F.col("my") * F.col("ny") - F.col("offset"))
    parallel = F.abs(F.col("dy") * F.col("nx") - F.col("dx") * F.col("ny")) / F.col("size")
    x = x.withColumn("away", away).where((parallel > 0.96) & (F.col("away") < 0.15))
    best = x.groupBy(scene, "room", "side").agg(F.min_by(F.struct("wall", "thick", "tolerance", "we"), F.struct("away", -F.col("long"), "wall")).alias("m"))
    half = F.coalesce(F.col("m.thick"), F.lit(default)) / 2
    sq = F.col("m.we.rms") * F.col("m.we.rms")
    per = best.groupBy(scene, "room").agg(
        F.count("*").alias("matched"), F.transform(F.array_sort(F.collect_list(F.struct("side", half.alias("d")))), lambda r: r["d"]).alias("own"), F.max(F.col("m.thick").isNull()).alias("guessed"), F.avg(F.coalesce("m.tolerance", F.lit(0.0))).alias("spread"),
        F.sum(sq).alias("squares"), F.sum("m.we.points").alias("points"), F.sum("m.we.density").alias("dense"), F.count("m.we.density").alias("with_density"), F.max("m.we.pose_sigma").alias("pose_sigma"), F.map_from_entries(F.array_distinct(F.collect_list(F.struct("m.wall", "m.thick")))).alias("thicknesses"),
    )
    y = good.join(per, [scene, "room"], "left").fillna(0, ["matched", "squares", "points", "dense", "with_density", "spread"])
    n = F.col("matched")
    own_density = F.col("e.density").isNotNull().cast("int")
    e = F.struct(
        F.sqrt((F.col("squares") + F.col("e.rms") * F.col("e.rms")) / (n + 1)).alias("rms"), (F.col("points") + F.col("e.points")).alias("points"), F.try_divide(F.col("dense") + F.coalesce(F.col("e.density"), F.lit(0.0)), (F.col("with_density") + own_density)).alias("density"),
        *[F.col(f"e.{c}").alias(c) for c in ("pose", "depth", "calibration")], F.greatest("pose_sigma", "e.pose_sigma").alias("pose_sigma"),
    )
    y = y.withColumn("be", e).withColumn("all", n == F.size("polygon"))
    spans = F.transform(F.arrays_zip(F.col("polygon").alias("p"), after.alias("q")), lambda s: F.hypot(s["q"]["x"] - s["p"]["x"], s["q"]["y"] - s["p"]["y"]))
    y = y.withColumn("around", F.aggregate(spans, F.lit(0.0), lambda a, v: a + v))
    y = y.withColumn("d", F.when(F.col("all"), F.col("own")).otherwise(F.transform("polygon", lambda _: F.lit(default / 2)))).withColumn("assumed", ~F.col("all") | F.coalesce("guessed", F.lit(True)))
    area = lambda p: F.abs(signed_area(p))
    base = F.col("around") * _sure(F.col("be")) / 2
    least = lambda s: F.greatest(s, F.lit(0.002))

    def grown(times: float, basis: str) -> Column:
        m = measurement(area(offset_polygon(F.col("polygon"), F.transform("d", lambda v: v * times))), F.col("be"), basis, sigma=least(base + F.col("around") * F.col("spread") * times / 2), assumed=F.col("assumed"))
        return m.withField("status", F.when(F.col("assumed"), "estimated").otherwise("measured"))

    y = y.select(scene, "room", measurement(area(F.col("polygon")), F.col("be"), "PRIMARY: supplied bounded interior TLS wall-face area", sigma=least(base)).alias("interior"), grown(1.0, CENTRE).alias("centreline"), grown(2.0, OUTER).alias("outer"), "thicknesses")
    none = unmeasured(*NO_ROOM)
    out = b.select(scene, "room", F.col("b.source").alias("boundary_source")).join(y, [scene, "room"], "left")
    return out.select(scene, "room", *[F.when(F.col(c).isNull(), none).otherwise(F.col(c)).alias(c) for c in ("interior", "centreline", "outer")], "boundary_source", "thicknesses")
