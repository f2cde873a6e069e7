"""Rotations, rigid poses and image frames as column expressions.

A rotation is a row-major array of nine numbers, a quaternion an array (x, y, z, w), a pose a
row-major array of sixteen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geometry import clip, dot

#: Metres that a radian of rotation counts for in a pose graph's objective.
ROTATION_METRES = 0.25
#: Above this cosine two rotations are so close that they are blended linearly.
NEARLY_EQUAL = 0.9995


def matrix_quaternion(m: Column) -> Column:
    """(x, y, z, w) of unit length of a rotation, from its trace or else its largest diagonal entry."""
    at = [[m[3 * i + j] for j in range(3)] for i in range(3)]
    trace = at[0][0] + at[1][1] + at[2][2]
    turn = [at[2][1] - at[1][2], at[0][2] - at[2][0], at[1][0] - at[0][1]]

    def about(i: int) -> Column:
        j, k = (i + 1) % 3, (i + 2) % 3
        s = 2 * F.sqrt(1 + at[i][i] - at[j][j] - at[k][k])
        q = {i: s / 4, j: (at[i][j] + at[j][i]) / s, k: (at[i][k] + at[k][i]) / s}
        return F.array(q[0], q[1], q[2], turn[i] / s)

    s = 2 * F.sqrt(trace + 1)
    d = [at[i][i] for i in range(3)]
    q = F.when(trace > 0, F.array(*[t / s for t in turn], s / 4))
    q = q.when((d[0] >= d[1]) & (d[0] >= d[2]), about(0)).when(d[1] >= d[2], about(1)).otherwise(about(2))
    return unit(q)


def unit(q: Column) -> Column:
    n = F.sqrt(F.aggregate(q, F.lit(0.0), lambda s, v: s + v * v))
    return F.transform(q, lambda v: v / n)


def slerp(a: Column, b: Column, t: Column) -> Column:
    """The rotation a share t of the way from a to b, along the shorter arc, both of unit length."""
    cosine = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)
    b = F.when(cosine < 0, F.transform(b, lambda v: -v)).otherwise(b)
    cosine = F.abs(cosine)
    theta = F.acos(clip(cosine, -1.0, 1.0))
    straight = unit(F.zip_with(a, b, lambda x, y: x + t * (y - x)))
    arc = F.zip_with(a, b, lambda x, y: (F.sin((1 - t) * theta) * x + F.sin(t * theta) * y) / F.sin(theta))
    return F.when(cosine > NEARLY_EQUAL, straight).otherwise(arc)


def slerp_any(a: Column, b: Column, t: Column) -> Column:
    """slerp of quaternions that need not be of unit length."""
    return slerp(unit(a), unit(b), t)


def rotation_of(pose: Column) -> list[Column]:
    return [pose[4 * i + j] for i in range(3) for j in range(3)]


def place_of(pose: Column) -> list[Column]:
    return [pose[4 * i + 3] for i in range(3)]


def _turned(r: list[Column], v: list[Column]) -> list[Column]:
    """The transpose of r times v."""
    return [dot([r[3 * k + i] for k in range(3)], v) for i in range(3)]


def relative(target: Column, source: Column) -> Column:
    """inverse(target) times source, as an array of sixteen; a rigid inverse is a transpose."""
    rt, rs = rotation_of(target), rotation_of(source)
    move = [s - t for s, t in zip(place_of(source), place_of(target), strict=True)]
    cols = [_turned(rt, [rs[3 * k + j] for k in range(3)]) for j in range(3)]
    shift = _turned(rt, move)
    rows = [x for i in range(3) for x in (cols[0][i], cols[1][i], cols[2][i], shift[i])]
    return F.array(*rows, *[F.lit(v) for v in (0.0, 0.0, 0.0, 1.0)])


def constraint_error(predicted: Column, measured: Column) -> tuple[Column, Column]:
    """(metres, radians) between a relative pose and its measurement; a rotation keeps lengths."""
    move = [p - m for p, m in zip(place_of(predicted), place_of(measured), strict=True)]
    trace = dot(rotation_of(predicted), rotation_of(measured))
    return F.sqrt(dot(move, move)), F.acos(clip((trace - 1) / 2, -1.0, 1.0))


def scaled_intrinsics(fx: Column, fy: Column, cx: Column, cy: Column, old: tuple[Column, Column], new: tuple[Column, Column]) -> Column:
    """(fx, fy, cx, cy) for images of another (width, height); sizes of 0 or less are an error."""
    bad = (old[0] <= 0) | (old[1] <= 0) | (new[0] <= 0) | (new[1] <= 0)
    sx, sy = new[0] / old[0], new[1] / old[1]
    made = F.struct((fx * sx).alias("fx"), (fy * sy).alias("fy"), (cx * sx).alias("cx"), (cy * sy).alias("cy"))
    return F.when(bad, F.raise_error(F.lit("an image size is not positive")).cast("struct<fx:double,fy:double,cx:double,cy:double>")).otherwise(made)


def display_rotation(pose: Column, up: list[Column]) -> Column:
    """Degrees clockwise (0, 90, 180, 270) that turn an image upright, from gravity in the camera's axes."""
    x, y, _ = _turned(rotation_of(pose), up)
    return F.when(F.abs(x) >= F.abs(y), F.when(x > 0, 270).otherwise(90)).otherwise(F.when(y < 0, 0).otherwise(180))


def rotated_box(box: list[Column], width: Column, height: Column, clockwise: Column) -> Column:
    """A box (x0, y0, x1, y1) in an image turned by 0, 90, 180 or 270 degrees; another turn is an error."""
    x0, y0, x1, y1 = box
    made = F.when(clockwise == 0, F.array(x0, y0, x1, y1)).when(clockwise == 90, F.array(height - y1, x0, height - y0, x1))
    made = made.when(clockwise == 270, F.array(y0, width - x1, y1, width - x0)).when(clockwise == 180, F.array(width - x1, height - y1, width - x0, height - y0))
    return made.otherwise(F.raise_error(F.lit("no such turn")).cast("array<double>"))
