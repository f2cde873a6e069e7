"""Rooms: overlaps, neighbours, names, what their floors and boundaries share with grids and walls."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import compass, point_in_polygon, signed_area

Point = tuple[float, float]


def _convex(p: np.ndarray) -> bool:
    """Whether a counter-clockwise polygon turns left only, and once round."""
    d = np.roll(p, -1, axis=0) - p
    n = np.roll(d, -1, axis=0)
    turn = np.arctan2(d[:, 0] * n[:, 1] - d[:, 1] * n[:, 0], (d * n).sum(axis=1))
    return bool(d.any(axis=1).all() and (turn >= 0).all() and turn.sum() < 3 * np.pi)


def _pieces(p: np.ndarray) -> list[np.ndarray]:
    """A simple polygon's convex parts: itself if it is convex, else triangles, by cutting ears.

    A rectangle thus stays whole, and what two of them share is as exact as their corners.
    """
    x, y = p[:, 0], p[:, 1]
    p = p if (x * np.roll(y, -1) - np.roll(x, -1) * y).sum() > 0 else p[::-1]
    if _convex(p):
        return [p]
    cross = lambda a, b, c: (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
    left, out = list(range(len(p))), []
    while len(left) > 2:
        for k in range(len(left)):
            a, b, c = p[left[k - 1]], p[left[k]], p[left[(k + 1) % len(left)]]
            turn = cross(a, b, c)
            rest = [q for q in p[left] if not any((q == v).all() for v in (a, b, c))]
            inside = any(cross(a, b, q) >= 0 and cross(b, c, q) >= 0 and cross(c, a, q) >= 0 for q in rest)
            if turn >= 0 and not inside:
                if turn > 0:
                    out.append(np.stack([a, b, c]))
                left.pop(k)
                break
        else:
            break  # crosses itself: what is left has no ear
    return out


def _clipped_area(subject: np.ndarray, clip: np.ndarray) -> float:
    """Area of a convex polygon inside a counter-clockwise convex one, cut by one side after the other."""
    for a, b in zip(clip, np.roll(clip, -1, axis=0), strict=True):
        side = (b[0] - a[0]) * (subject[:, 1] - a[1]) - (b[1] - a[1]) * (subject[:, 0] - a[0])
        out = []
        for i in range(len(subject)):
            s, t, p, q = side[i - 1], side[i], subject[i - 1], subject[i]
            if (s >= 0) != (t >= 0):
                out.append(p + (q - p) * s / (s - t))
            if t >= 0:
                out.append(q)
        if len(out) < 3:
            return 0.0
        subject = np.array(out)
    x, y = subject[:, 0], subject[:, 1]
    return abs(float((x * np.roll(y, -1) - np.roll(x, -1) * y).sum())) / 2


def overlap_area(a: np.ndarray, b: np.ndarray) -> float:
    """Area that two simple polygons share."""
    other = _pieces(b)
    return sum(_clipped_area(s, t) for s in _pieces(a) for t in other)


def room_overlaps(rooms: DataFrame, scene: str, tolerance: float = 0.01, side: float = 4.0) -> DataFrame:
    """(scene, a, b, fraction): rooms a < b of a scene that share more than `tolerance` of the smaller one.

    rooms(scene, id, polygon), polygon an array of structs (x, y).  Only rooms whose boxes touch a common
    square of `side` metres are compared, so a scene's rooms are no cross join; polygons of fewer than
    three points or without area are left out.
    """
    x = rooms.where(F.size("polygon") >= 3).withColumn("area", F.abs(signed_area(F.col("polygon")))).where("area > 0")
    cells = lambda c: F.sequence(F.floor(F.array_min(F.col("polygon")[c]) / side), F.floor(F.array_max(F.col("polygon")[c]) / side))
    at = x.select(scene, "id", F.explode(cells("x")).alias("cu"), "polygon").select(scene, "id", "cu", F.explode(cells("y")).alias("cv"))
    pairs = at.withColumnRenamed("id", "a").join(at.withColumnRenamed("id", "b"), [scene, "cu", "cv"]).where("a < b").select(scene, "a", "b").distinct()
    for n in ("a", "b"):
        pairs = pairs.join(x.select(scene, F.col("id").alias(n), F.col("polygon").alias(f"p{n}"), F.col("area").alias(f"s{n}")), [scene, n])

    @F.pandas_udf("double")
    def shared(a: pd.Series, b: pd.Series) -> pd.Series:
        points = lambda p: np.array([(v["x"], v["y"]) for v in p])
        return pd.Series([overlap_area(points(p), points(q)) for p, q in zip(a, b, strict=True)])

    fraction = shared("pa", "pb") / F.least("sa", "sb")
    return pairs.select(scene, "a", "b", fraction.alias("fraction")).where(F.col("fraction") > tolerance)


def adjacency_errors(rooms: DataFrame, edges: DataFrame, scene: str) -> DataFrame:
    """(scene, room, other, error): neighbours that are unknown, the room itself, or do not list it, and edges to unknown rooms.

    rooms(scene, id, neighbours), edges(scene, a, b).
    """
    known = rooms.select(scene, F.col("id").alias("other")).distinct().withColumn("known", F.lit(True))
    listed = rooms.select(scene, F.col("id").alias("room"), F.explode("neighbours").alias("other"))
    back = listed.select(scene, F.col("other").alias("room"), F.col("room").alias("other")).distinct().withColumn("back", F.lit(True))
    x = listed.join(known, [scene, "other"], "left").join(back, [scene, "room", "other"], "left")
    error = F.when(F.col("room") == F.col("other"), "self").when(F.col("known").isNull(), "unknown").when(F.col("back").isNull(), "asymmetric")
    bad = x.select(scene, "room", "other", error.alias("error")).where("error is not null")
    ends = edges.select(scene, F.col("a").alias("room"), F.col("b").alias("other"), F.explode(F.array("a", "b")).alias("end"))
    lost = ends.join(known.withColumnRenamed("other", "end"), [scene, "end"], "left_anti").select(scene, "room", "other", F.lit("edge to unknown room").alias("error")).distinct()
    return bad.unionByName(lost)


def room_neighbours(members: DataFrame, scene: str) -> DataFrame:
    """(scene, room, other): rooms that share a wall, both ways, each pair once. members(scene, wall, room)."""
    m = members.select(scene, "wall", "room").distinct()
    pairs = m.join(m.withColumnRenamed("room", "other"), [scene, "wall"]).where("room <> other")  # a wall has two rooms or so
    return pairs.select(scene, "room", "other").distinct()


def wall_names(walls: DataFrame, scene: str) -> DataFrame:
    """walls with name: `room.direction_wall`, longest first, later ones of a name numbered from 2.

    walls(scene, room, room_name, rx, ry, wall, length, nx, ny, mx, my): the room's and the wall's middle, the
    wall's normal on either side.
    """
    inward = F.signum((F.col("rx") - F.col("mx")) * F.col("nx") + (F.col("ry") - F.col("my")) * F.col("ny"))
    sign = F.when(inward < 0, 1.0).otherwise(-1.0)
    base = F.concat("room_name", F.lit("."), compass(sign * F.col("nx"), sign * F.col("ny")), F.lit("_wall"))
    x = walls.withColumn("base", base)
    place = F.row_number().over(Window.partitionBy(scene, "room", "base").orderBy(F.desc("length"), "wall"))
    return x.withColumn("place", place).withColumn("name", F.when(F.col("place") == 1, F.col("base")).otherwise(F.concat("base", F.lit("_"), F.col("place").cast("string")))).drop("base", "place")


def adjacency_via(edges: DataFrame, openings: DataFrame, scene: str, most: float = 1.2) -> DataFrame:
    """(scene, a, b, via): the wall of the nearest door or pass-through, if nearer than `most` to the middle between two rooms.

    edges(scene, a, b, x, y) with that middle, openings(scene, place, kind, room, name, mx, my) with their wall's.
    """
    doors = openings.where("kind in ('door', 'pass-through')").withColumnRenamed("room", "owner")
    ends = edges.select(scene, "a", "b", "x", "y", F.explode(F.array_distinct(F.array("a", "b"))).alias("owner"))
    d = F.hypot(F.col("mx") - F.col("x"), F.col("my") - F.col("y"))
    near = ends.join(doors, [scene, "owner"]).withColumn("d", d).where(F.col("d") < most)
    best = near.groupBy(scene, "a", "b").agg(F.min_by("name", F.struct("d", "place")).alias("via"))
    return edges.select(scene, "a", "b").join(best, [scene, "a", "b"], "left")


def observed_rooms(polygons: DataFrame, cells: DataFrame, scene: str, side: float = 1.0) -> DataFrame:
    """polygons(scene, id, polygon) that cover the middle of a free cell of cells(scene, x, y).

    Cells and the boxes of polygons meet in squares of `side`, so no polygon sees all cells.
    """
    square = lambda c: F.floor(F.col(c) / side)
    span = lambda c: F.sequence(F.floor(F.array_min(F.col("polygon")[c]) / side), F.floor(F.array_max(F.col("polygon")[c]) / side))
    boxes = polygons.select(scene, "id", "polygon", F.explode(span("x")).alias("su")).select(scene, "id", "polygon", "su", F.explode(span("y")).alias("sv"))
    free = cells.select(scene, "x", "y", square("x").alias("su"), square("y").alias("sv"))
    hit = boxes.hint("merge").join(free.hint("merge"), [scene, "su", "sv"]).where(point_in_polygon(F.col("x"), F.col("y"), F.col("polygon")))
    return polygons.join(hit.select(scene, "id").distinct(), [scene, "id"], "left_semi")


def shared_boundary(walls: DataFrame, rooms: DataFrame, scene: str, near: float = 1e-6) -> DataFrame:
    """(scene, wall, room, shared): walls that run along a room's boundary for 0.15 m or 0.35 of their length.

    walls(scene, wall, x0, y0, x1, y1), rooms(scene, id, polygon).  Only edges on the wall's line, to `near`, count.
    """
    after = F.concat(F.slice("polygon", 2, F.size("polygon") - 1), F.slice("polygon", 1, 1))
    edges = rooms.select(scene, F.col("id").alias("room"), F.explode(F.arrays_zip(F.col("polygon").alias("p"), after.alias("q"))).alias("e"))
    length = F.hypot(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    x = walls.withColumn("length", length).where("length > 1e-6").join(edges, scene)  # a scene's walls and edges, both tens
    dx, dy = (F.col("x1") - F.col("x0")) / F.col("length"), (F.col("y1") - F.col("y0")) / F.col("length")

    def along(p: str) -> Column:
        return (F.col(f"e.{p}.x") - F.col("x0")) * dx + (F.col(f"e.{p}.y") - F.col("y0")) * dy

    def off(p: str) -> Column:
        return F.abs((F.col(f"e.{p}.x") - F.col("x0")) * dy - (F.col(f"e.{p}.y") - F.col("y0")) * dx)

    run = F.least(F.col("length"), F.greatest(along("p"), along("q"))) - F.greatest(F.lit(0.0), F.least(along("p"), along("q")))
    x = x.where((off("p") <= near) & (off("q") <= near)).withColumn("run", F.greatest(run, F.lit(0.0)))
    out = x.groupBy(scene, "wall", "room", "length").agg(F.sum("run").alias("shared"))
    return out.where(F.col("shared") >= F.least(F.lit(0.15), 0.35 * F.col("length"))).select(scene, "wall", "room", "shared")
