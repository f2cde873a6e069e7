"""Rooms of plans: faces of the wall graph that floor was seen in, else parts of the seen floor."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import grids, rings, rooms
from .graphs import checkpointed
from .joins import small


def rasterised_walls(walls: DataFrame, scene: str, resolution: float, size: DataFrame) -> DataFrame:
    """(scene, cu, cv): the cells that walls pass, and those beside them, inside size(scene, u0, v0, columns, rows).

    walls(scene, wall, x0, y0, x1, y1) are sampled twice a cell, at both ends at least.
    """
    length = F.hypot(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    steps = F.greatest(F.floor(length / resolution) * 2, F.lit(2))
    x = walls.join(small(size), scene).withColumn("steps", steps).withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("steps") - 1)))
    share = F.col("k") / (F.col("steps") - 1)
    at = lambda a, b, o: F.floor((F.col(a) + share * (F.col(b) - F.col(a)) - F.col(o)) / resolution).cast("long")
    inside = "cu >= 0 and cv >= 0 and cu < columns and cv < rows"
    cells = x.select(scene, at("x0", "x1", "u0").alias("cu"), at("y0", "y1", "v0").alias("cv"), "columns", "rows").where(inside).select(scene, "cu", "cv").distinct()
    return grids.dilate(cells, [scene]).join(small(size), scene).where(inside).select(scene, "cu", "cv")


def probed_walls(walls: DataFrame, labels: DataFrame, scene: str, resolution: float, origin: tuple[float, float] = (0.0, 0.0), away: float = 0.12) -> DataFrame:
    """(scene, wall, room, hits): rooms whose cells lie just off either face of a wall, along enough of it.

    walls(scene, wall, x0, y0, x1, y1), labels(scene, cu, cv, room).  A wall is probed once a cell from 0.05 to
    0.95 of its length on both sides; a room needs three hits and 0.15 of one side's probes.  Probes of a cell are
    counted before the join, a shuffle join: Spark takes labels that were exploded for smaller than they are.
    """
    length = F.hypot(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    x = walls.withColumn("length", length).where("length > 0").withColumn("steps", F.greatest(F.floor(F.col("length") / resolution), F.lit(2)))
    x = x.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("steps") - 1))).withColumn("side", F.explode(F.array(F.lit(1.0), F.lit(-1.0))))
    share = 0.05 + 0.9 * F.col("k") / (F.col("steps") - 1)
    nx, ny = F.try_divide(F.col("y0") - F.col("y1"), F.col("length")), F.try_divide(F.col("x1") - F.col("x0"), F.col("length"))
    at = lambda a, b, n, o: F.floor((F.col(a) + share * (F.col(b) - F.col(a)) + n * F.col("side") * away - o) / resolution).cast("long")
    probes = x.select(scene, "wall", "steps", at("x0", "x1", nx, origin[0]).alias("cu"), at("y0", "y1", ny, origin[1]).alias("cv"))
    probes = probes.groupBy(scene, "wall", "steps", "cu", "cv").agg(F.count("*").alias("n"))
    hits = probes.hint("merge").join(labels.hint("merge"), [scene, "cu", "cv"]).groupBy(scene, "wall", "room", "steps").agg(F.sum("n").alias("hits"))
    return hits.where(F.col("hits") >= F.greatest(F.lit(3.0), 0.15 * F.col("steps"))).select(scene, "wall", "room", "hits")


def segmented_rooms(cells: DataFrame, walls: DataFrame, scene: str, resolution: float, origin: tuple[float, float] = (0.0, 0.0), least: float = 1.4, wall: int = 6, floor: int = 3, tolerance: float = 0.08) -> tuple[DataFrame, DataFrame]:
    """(rooms, scenes) of plans' cells(scene, cu, cv, occupied, free) and walls(scene, wall, x0, y0, x1, y1).

    rooms(scene, room, name, source, area, cx, cy, polygon, walls, neighbours): the faces that the walls bound and that
    hold the middle of a cell of seen floor.  A scene without such a face has the parts of its seen floor instead, joined
    by sides or corners, of three cells and an area of `least` or more, if one outline bounds all of it.  Rooms are
    numbered by centroid; walls are those along a room's outline, neighbours the rooms that share one.
    scenes(scene, n, fallback, reason): why a scene has no room, else null.
    """
    free = checkpointed(cells.where((F.col("free") >= floor) & (F.col("occupied") < wall)).select(scene, "cu", "cv").distinct())
    faces = checkpointed(rings.wall_faces(walls, scene, least, tolerance).where("reason is null").select(scene, F.col("face").alias("id"), "area", "cx", "cy", "polygon"))
    middle = lambda c, o: (o + (F.col(c) + 0.5) * resolution).alias("xy"[c == "cv"])
    seen = checkpointed(rooms.observed_rooms(faces, free.select(scene, middle("cu", origin[0]), middle("cv", origin[1])), scene).withColumn("source", F.lit("wall-face")))
    rest = free.join(seen.select(scene).distinct(), scene, "left_anti")
    parts = grids.label_groups(rest, [scene], diagonal=True)
    outlines = rings.outline_rings(parts, [scene, "label"]).groupBy(scene, "label").agg(F.count("*").alias("rings"), F.first("corners").alias("corners"), F.sum("area").alias("n"))
    on_plan = F.transform("corners", lambda p: F.struct((origin[0] + p["x"] * resolution).alias("x"), (origin[1] + p["y"] * resolution).alias("y")))
    centre = parts.groupBy(scene, "label").agg(*[(F.avg(c) + 0.5).alias(f"m{c}") for c in ("cu", "cv")])
    whole = outlines.where("rings = 1 and n >= 3").withColumn("area", F.col("n") * resolution * resolution).where(F.col("area") >= least).join(centre, [scene, "label"])
    whole = whole.select(scene, "area", (origin[0] + F.col("mcu") * resolution).alias("cx"), (origin[1] + F.col("mcv") * resolution).alias("cy"), on_plan.alias("polygon"), F.lit("floor-component").alias("source"))
    found = seen.drop("id").unionByName(whole)
    place = F.row_number().over(Window.partitionBy(scene).orderBy(F.round("cx", 8), F.round("cy", 8), F.round("area", 8))) - 1
    found = checkpointed(found.withColumn("room", place))
    member = checkpointed(rooms.shared_boundary(walls, found.select(scene, F.col("room").alias("id"), "polygon"), scene).select(scene, "wall", "room"))
    listed = lambda df, c, n: df.groupBy(scene, "room").agg(F.array_sort(F.collect_set(c)).alias(n))
    out = found.join(listed(member, "wall", "walls"), [scene, "room"], "left").join(listed(rooms.room_neighbours(member, scene), "other", "neighbours"), [scene, "room"], "left")
    out = out.withColumn("name", F.concat(F.lit("room_"), (F.col("room") + 1).cast("string"))).select(scene, "room", "name", "source", "area", "cx", "cy", "polygon", "walls", "neighbours")
    tally = lambda df, n: df.groupBy(scene).agg(F.count("*").alias(n))
    s = cells.select(scene).union(walls.select(scene)).distinct()
    for df, n in ((faces, "faces"), (seen, "seen"), (free, "cells"), (found, "n")):
        s = s.join(tally(df, n), scene, "left")
    s = s.fillna(0, ["faces", "seen", "cells", "n"])
    why = F.concat_ws("; ", F.when(F.col("faces") == 0, "no-bounded-wall-faces").when(F.col("seen") == 0, "candidate-faces-have-no-observed-floor"), F.when(F.col("cells") == 0, "no-observed-free-cells").otherwise("no-usable-observed-floor-components"))
    return out, s.select(scene, "n", (F.col("seen") == 0).alias("fallback"), F.when(F.col("n") == 0, why).alias("reason"))
