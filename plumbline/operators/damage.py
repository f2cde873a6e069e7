"""Damage from detections in frames to regions on surfaces: back-projection, surfaces, votes, regions.

Boxes meet the pixels of their frame in tiles, points meet walls in squares of the plan and votes
meet in cells, so every join is an equi-join that spreads over the cluster, whatever a frame's or a
surface's share of all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.measures import evidence_confidence
from . import evidence, grids
from .graphs import checkpointed
from .joins import small
from .rings import _squares

TILE = 16


def project_boxes(detections: DataFrame, pixels: DataFrame, cameras: DataFrame) -> DataFrame:
    """(capture, frame, det, pu, pv, x, y, z, rx, ry, rz): the pixel, the point and the unit view ray in the world of each box's pixels.

    detections(capture, frame, det, x0, y0, x1, y1) in pixels, ends not included; pixels(capture, frame, u, v,
    depth), those without a positive depth are left out; cameras(capture, frame, pose, fx, fy, cx, cy), pose 16 numbers
    from the camera to the world, row by row.
    """
    tiles = lambda a, b: F.sequence(F.floor(F.col(a) / TILE), F.floor((F.col(b) - 1) / TILE))
    boxes = detections.where("x1 > x0 and y1 > y0").select("capture", "frame", "det", "x0", "y0", "x1", "y1", F.explode(tiles("x0", "x1")).alias("tu")).select("*", F.explode(tiles("y0", "y1")).alias("tv"))
    seen = pixels.where("depth > 0 and not isnan(depth) and depth < double('infinity')").select("capture", "frame", "u", "v", F.col("depth").cast("double").alias("d"), F.floor(F.col("u") / TILE).alias("tu"), F.floor(F.col("v") / TILE).alias("tv"))
    x = seen.join(boxes, ["capture", "frame", "tu", "tv"]).where("u >= x0 and u < x1 and v >= y0 and v < y1")
    x = x.select("capture", "frame", "det", "u", "v", "d").join(small(cameras), ["capture", "frame"])
    cam = [(F.col("u") - F.col("cx")) * F.col("d") / F.col("fx"), (F.col("v") - F.col("cy")) * F.col("d") / F.col("fy"), F.col("d")]
    size = F.greatest(F.sqrt(cam[0] * cam[0] + cam[1] * cam[1] + cam[2] * cam[2]), F.lit(1e-9))
    turned = [sum((F.col("pose")[4 * i + j] * c for j, c in enumerate(cam)), F.lit(0.0)) for i in range(3)]
    return x.select("capture", "frame", "det", F.col("u").alias("pu"), F.col("v").alias("pv"), *[(t + F.col("pose")[4 * i + 3]).alias(n) for i, (t, n) in enumerate(zip(turned, "xyz", strict=True))], *[(t / size).alias(f"r{n}") for t, n in zip(turned, "xyz", strict=True)])


def assigned_points(points: DataFrame, walls: DataFrame, levels: DataFrame, tolerance: float = 0.12, side: float = 1.0) -> DataFrame:
    """points with the surface that is nearest within the tolerance: surface, u, v, incidence (|ray . normal|).

    points as project_boxes gives them, z up; walls(capture, surface, x0, y0, x1, y1, base) with a wall's
    start, end and foot, to a tenth of a metre beyond its ends; levels(capture, surface, z), floors and ceilings.  Of equal
    distances the smallest surface counts; a point near none is left out.  u runs along a wall, v up from its base; both are
    null on a level.
    """
    length = F.hypot(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    w = walls.withColumn("length", length).where("length > 0")
    at = _squares(w.withColumnRenamed("surface", "wall"), "capture", side, tolerance + 0.1).select("capture", F.col("wall").alias("surface"), "cu", "cv")
    p = points.withColumn("cu", F.floor(F.col("x") / side)).withColumn("cv", F.floor(F.col("y") / side))
    dx, dy = F.try_divide(F.col("x1") - F.col("x0"), F.col("length")), F.try_divide(F.col("y1") - F.col("y0"), F.col("length"))
    x = p.join(at, ["capture", "cu", "cv"]).join(small(w.select("capture", "surface", "base", "x0", "y0", "length", dx.alias("dx"), dy.alias("dy"))), ["capture", "surface"])
    off = F.abs((F.col("x") - F.col("x0")) * F.col("dy") - (F.col("y") - F.col("y0")) * F.col("dx"))
    u = (F.col("x") - F.col("x0")) * F.col("dx") + (F.col("y") - F.col("y0")) * F.col("dy")
    key = ("capture", "frame", "det", "pu", "pv")
    cols = lambda surface, u, v, d, cosine: [*key, F.struct(d.alias("d"), surface.alias("surface")).alias("rank"), F.struct(u.alias("u"), v.alias("v"), F.abs(cosine).alias("incidence")).alias("on")]
    on_walls = x.where((off < tolerance) & (u > -0.1) & (u < F.col("length") + 0.1)).select(*cols(F.col("surface"), u, F.col("z") - F.col("base"), off, F.col("rx") * F.col("dy") - F.col("ry") * F.col("dx")))
    none = F.lit(None).cast("double")
    lv = points.join(small(levels.select("capture", "surface", F.col("z").alias("level"))), "capture")
    gap = F.abs(F.col("z") - F.col("level"))
    on_levels = lv.where(gap < tolerance).select(*cols(F.col("surface"), none, none, gap, F.col("rz")))
    best = on_walls.unionByName(on_levels).groupBy(*key).agg(F.min("rank").alias("rank"), F.min_by("on", "rank").alias("on"))
    return best.select(*key, "rank.surface", "on.u", "on.v", "on.incidence")


def surface_votes(assigned: DataFrame, surfaces: DataFrame, resolution: float, grazing: float = 0.26) -> DataFrame:
    """(capture, surface, cu, cv, frame, det, weight): a vote for the cell of each point on a wall, by its detection's mean incidence there.

    surfaces(capture, surface, width, height); points beyond them have no cell.  Detections that graze a surface have no votes.
    """
    weight = evidence.incidence_weight(assigned.withColumn("k", F.struct("capture", "surface", "det")), "k", F.col("incidence"), grazing).where("weight > 0")
    weight = weight.select("k.capture", "k.surface", "k.det", "weight")
    cell = lambda c: F.floor(F.col(c) / resolution).cast("long")
    x = assigned.join(small(surfaces), ["capture", "surface"]).where("u >= 0 and u < width and v >= 0 and v < height")
    return x.join(weight, ["capture", "surface", "det"]).select("capture", "surface", cell("u").alias("cu"), cell("v").alias("cv"), "frame", "det", "weight")


def damage_regions(votes: DataFrame, detections: DataFrame, surfaces: DataFrame, resolution: float, attributes: list[str], views: int = 2, weight: float = 0.6, area: float = 0.02, radius: int = 2) -> DataFrame:
    """A row for each region of damage: (capture, id, surface, damage_class, combined, area, u0, u1, v0, v1, views, confidence, frames, evidence, methods, attributes).

    votes as surface_votes gives them; detections(capture, det, frame, class, confidence, evidence, method, place, attributes).
    Cells with enough votes and weight are closed by a square, rid of what no block of 2 x 2 cells covers, and
    joined by their sides; parts of enough area are regions, numbered on each surface by their first cell.  Attributes are the surface's
    consensus on the region's class, of its two classes where they are combined.
    """
    at = ["capture", "surface"]
    cell = [*at, "cu", "cv"]
    said = detections.withColumnRenamed("class", "cls")
    v = checkpointed(votes.join(said.select("capture", "det", "cls", "confidence"), ["capture", "det"]))
    cells = checkpointed(v.groupBy(*cell).agg(F.count("*").alias("views"), F.sum("weight").alias("weight")))
    size = surfaces.select(*at, F.greatest(F.ceil(F.col("width") / resolution), F.lit(1)).alias("columns"), F.greatest(F.ceil(F.col("height") / resolution), F.lit(1)).alias("rows"))
    inside = lambda x: x.join(small(size), at).where("cu >= 0 and cv >= 0 and cu < columns and cv < rows").select(*cell)
    good = cells.where((F.col("views") >= views) & (F.col("weight") >= weight)).select(*cell)
    closed = grids.erode(inside(grids.dilate(good, at, radius)), at, radius)
    corner = lambda x, steps: x.withColumn("a", F.explode(F.array(*map(F.lit, steps)))).withColumn("b", F.explode(F.array(*map(F.lit, steps)))).select(*at, (F.col("cu") + F.col("a")).alias("cu"), (F.col("cv") + F.col("b")).alias("cv"))
    blocks = corner(closed, (-1, 0)).groupBy(*cell).count().where("count = 4").select(*cell)
    labels = checkpointed(grids.label_groups(corner(blocks, (0, 1)).distinct(), at, diagonal=False))
    part = [*at, "label"]
    number = F.row_number().over(Window.partitionBy(*at).orderBy("first"))
    parts = labels.join(cells, cell, "left").groupBy(*part).agg(F.count("*").alias("n"), F.min("cu").alias("a"), (F.max("cu") + 1).alias("b"), F.min("cv").alias("c"), (F.max("cv") + 1).alias("d"), F.min(F.struct("cu", "cv")).alias("first"), F.max(F.coalesce("views", F.lit(0))).alias("views"), F.avg(F.coalesce("weight", F.lit(0.0))).alias("mean"))
    parts = checkpointed(parts.withColumn("number", number).withColumn("area", F.col("n") * resolution * resolution).where(F.col("area") >= area))
    of = labels.join(parts.select(*part, "number"), part).select(*cell, "number")
    tally = v.join(of, cell).withColumn("region", F.struct(*at, "number"))
    top = evidence.dominant_class(tally, "region", "cls", F.col("weight") * F.col("confidence"))
    # what all detections on a surface say, by class
    given = votes.select(*at, "det", "weight").distinct().join(said, ["capture", "det"]).withColumn("on", F.struct(*at))
    voted = checkpointed(evidence.consensus(given, "on", "cls", attributes))
    regions = parts.withColumn("region", F.struct(*at, "number")).join(top, "region", "left").withColumn("on", F.struct(*at))
    two = F.col("dominant") == "combined"
    pairs = regions.select("region", "on", "top", F.when(two, F.col("second")).alias("second"))
    one = lambda c, n: pairs.select("region", "on", F.col(c).alias("cls")).join(voted, ["on", "cls"]).select("region", F.struct(*attributes, "confidence", "frames", "evidence").alias(n))
    x = regions.join(one("top", "p"), "region", "left").join(one("second", "q"), "region", "left")
    both = F.col("q.confidence").isNotNull()
    sure = F.when(both, (F.col("p.confidence") + F.col("q.confidence")) / 2).otherwise(F.col("p.confidence"))
    methods = given.groupBy(*at).agg(F.concat_ws(",", F.array_sort(F.collect_set("method"))).alias("methods"))
    frames = F.array_sort(F.array_union("p.frames", F.coalesce("q.frames", F.array().cast(dict(voted.dtypes)["frames"]))))
    told = F.slice(F.concat("p.evidence", F.coalesce("q.evidence", F.array().cast("array<string>"))), 1, 4)
    x = x.join(methods, at, "left")
    return x.select(
        "capture", F.concat_ws("#", "surface", "number").alias("id"), "surface", F.col("dominant").alias("damage_class"), F.when(two, F.array("top", "second")).alias("combined"), "area",
        *[(F.col(k) * resolution).alias(n) for k, n in zip("abcd", ("u0", "u1", "v0", "v1"), strict=True)], "views", evidence_confidence(F.col("views"), F.col("mean"), sure).alias("confidence"), frames.alias("frames"), told.alias("evidence"), F.when(F.coalesce("methods", F.lit("")) == "", "unknown").otherwise(F.col("methods")).alias("methods"),
        *[F.coalesce(f"p.{c}", f"q.{c}").alias(c) for c in attributes],
    )


def damage_pass(detections: DataFrame, pixels: DataFrame, cameras: DataFrame, walls: DataFrame, levels: DataFrame, attributes: list[str], resolution: float = 0.04, least: float = 0.5, furniture: str = "furniture", **limits) -> DataFrame:
    """Damage regions of all captures, from their detections: less sure ones and furniture are left out.

    walls(capture, surface, x0, y0, x1, y1, base, width, height); the rest as the steps take it.
    """
    sure = detections.where((F.col("confidence") >= least) & (F.col("class") != furniture))
    points = project_boxes(sure.select("capture", "frame", "det", "x0", "y0", "x1", "y1"), pixels, cameras)
    assigned = checkpointed(assigned_points(points, walls.drop("width", "height"), levels))
    surfaces = walls.select("capture", "surface", "width", "height")
    votes = checkpointed(surface_votes(assigned, surfaces, resolution))
    return damage_regions(votes, sure, surfaces, resolution, attributes, **limits)
