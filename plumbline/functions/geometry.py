"""Vectors, quaternions, polygons and intervals as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: list[Column], b: list[Column]) -> Column:
    out = a[0] * b[0]
    for x, y in zip(a[1:], b[1:], strict=True):
        out = out + x * y
    return out


def norm(a: list[Column]) -> Column:
    return F.sqrt(dot(a, a))


def clip(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def quaternion_matrix(x: Column, y: Column, z: Column, w: Column) -> Column:
    """Row-major rotation of a quaternion that need not be of unit length; identity for zero."""
    n = norm([x, y, z, w])
    n = F.when(n > 0, n)
    x, y, z, w = x / n, y / n, z / n, w / n
    m = [1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w), 2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w), 2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)]
    eye = F.array(*[F.lit(float(i % 4 == 0)) for i in range(9)])
    return F.when(n.isNotNull(), F.array(*m)).otherwise(eye)


def rotation_degrees(a: Column, b: Column) -> Column:
    """Angle between two rotation matrices given as arrays of nine."""
    trace = F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)
    return F.degrees(F.acos(clip((trace - 1) / 2, -1.0, 1.0)))


def compass(x: Column, y: Column) -> Column:
    """Eight-way name of a direction, x to the east and y to the north; a border belongs to the next name clockwise."""
    names = F.array(*[F.lit(n) for n in ("north", "northeast", "east", "southeast", "south", "southwest", "west", "northwest")])
    return F.element_at(names, (F.pmod(F.floor((F.pmod(F.degrees(F.atan2(x, y)), F.lit(360.0)) + 22.5) / 45), F.lit(8)) + 1).cast("int"))


def canonical_sign(x: Column, y: Column, eps: float = 1e-9) -> Column:
    """1 or -1: the sign that makes a 2-D normal point right, or up if it points neither way."""
    return F.when((x < -eps) | ((F.abs(x) <= eps) & (y < 0)), -1.0).otherwise(1.0)


def manhattan_deviation(x: Column, y: Column) -> Column:
    """Degrees between a direction and the nearest axis."""
    deg = F.degrees(F.atan2(y, x))
    return F.abs(deg - F.bround(deg / 90) * 90)


def overlap(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    """Intersection over union of two intervals; 0 for an empty union."""
    union = F.greatest(a[1], b[1]) - F.least(a[0], b[0])
    return F.when(union <= 1e-9, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(a[1], b[1]) - F.greatest(a[0], b[0])) / union)


def signed_area(polygon: Column) -> Column:
    """Shoelace area of an array of structs (x, y)."""
    after = F.concat(F.slice(polygon, 2, F.size(polygon) - 1), F.slice(polygon, 1, 1))
    return F.aggregate(F.zip_with(polygon, after, lambda p, q: p["x"] * q["y"] - q["x"] * p["y"]), F.lit(0.0), lambda s, v: s + v) / 2


def point_in_polygon(x: Column, y: Column, polygon: Column) -> Column:
    """Even-odd test against an array of structs (x, y)."""
    after = F.concat(F.slice(polygon, 2, F.size(polygon) - 1), F.slice(polygon, 1, 1))
    crosses = F.zip_with(polygon, after, lambda p, q: F.when((p["y"] > y) != (q["y"] > y), x < (q["x"] - p["x"]) * (y - p["y"]) / (q["y"] - p["y"]) + p["x"]).otherwise(F.lit(False)))
    return F.aggregate(crosses, F.lit(False), lambda s, c: s != c)


def line_angle(sxx: Column, syy: Column, sxy: Column) -> Column:
    """Direction in radians of the total-least-squares line of centred second moments."""
    return F.atan2(2 * sxy, sxx - syy) / 2


DEGREES_70 = math.cos(math.radians(70.0))
