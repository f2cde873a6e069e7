"""Plan frames, walls and planes as column expressions.

Vectors are lists of columns.  A frame has three unit vectors: right, forward, up.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geometry import canonical_sign, clip, dot, norm


def to_plan(p: list[Column], right: list[Column], forward: list[Column]) -> list[Column]:
    return [dot(p, right), dot(p, forward)]


def to_world(plan: list[Column], height: Column, right: list[Column], forward: list[Column], up: list[Column]) -> list[Column]:
    return [plan[0] * r + plan[1] * f + height * u for r, f, u in zip(right, forward, up, strict=True)]


def signed_distance(p: list[Column], normal: list[Column], offset: Column) -> Column:
    return dot(p, normal) - offset


def along(p: list[Column], start: list[Column], direction: list[Column]) -> Column:
    return dot([a - b for a, b in zip(p, start, strict=True)], direction)


def inferred_fraction(length: Column, seen_from: Column, seen_to: Column) -> Column:
    """The share of a wall's length that nothing was seen of; 0 for a wall without length."""
    return F.when(length < 1e-6, 0.0).otherwise(clip(1 - F.greatest(F.lit(0.0), seen_to - seen_from) / length, 0.0, 1.0))


def quarter_turns(x: Column, y: Column) -> Column:
    """Which of the four axes a 2-D normal is nearest to, halves to even."""
    return F.pmod(F.bround(F.atan2(y, x) / (math.pi / 2)), F.lit(4)).cast("int")


def nearest_axis(x: Column, y: Column) -> list[Column]:
    """The nearest axis with its sign made canonical: right or up."""
    odd = F.pmod(quarter_turns(x, y), F.lit(2)) == 1
    return [F.when(odd, 0.0).otherwise(1.0), F.when(odd, 1.0).otherwise(0.0)]


def snapped_wall(normal: list[Column], start: list[Column], end: list[Column], tolerance: float = 8.0) -> Column:
    """A wall turned onto the nearest axis about its middle: (off_axis, nx, ny, offset, x0, y0, x1, y1).

    A wall that is farther than the tolerance from every axis is off_axis and stays as it is.
    """
    angle = F.atan2(normal[1], normal[0])
    turned = quarter_turns(*normal) * (math.pi / 2)
    off = F.abs(F.degrees(angle - turned)) > tolerance
    n = nearest_axis(*normal)
    middle = [(a + b) / 2 for a, b in zip(start, end, strict=True)]
    half = norm([b - a for a, b in zip(start, end, strict=True)]) / 2
    offset, d = dot(n, middle), [-n[1], n[0]]
    centre = [a * offset + b * dot(d, middle) for a, b in zip(n, d, strict=True)]
    ends = [c + s * half * v for s in (-1, 1) for c, v in zip(centre, d, strict=True)]
    was = [*normal, dot(normal, middle), *start, *end]
    names = ("nx", "ny", "offset", "x0", "y0", "x1", "y1")
    return F.struct(off.alias("off_axis"), *[F.when(off, a).otherwise(b).alias(c) for a, b, c in zip(was, [*n, offset, *ends], names, strict=True)])


def canonical_plane_normal(n: list[Column]) -> list[Column]:
    """A unit normal whose largest component (the first of equal ones) is positive; z where there is none."""
    size = norm(n)
    a = [F.abs(c) for c in n]
    pivot = F.when((a[0] >= a[1]) & (a[0] >= a[2]), n[0]).when(a[1] >= a[2], n[1]).otherwise(n[2])
    sign = F.when(pivot < 0, -1.0).otherwise(1.0)
    bad = F.isnan(size) | (size <= 1e-12) | (size == math.inf)
    return [F.when(bad, F.lit(float(i == 2))).otherwise(sign * c / size) for i, c in enumerate(n)]


def plane_from_three(a: list[Column], b: list[Column], c: list[Column]) -> Column:
    """(nx, ny, nz, offset) of the plane through three points; null if they lie on a line."""
    u, v = ([q - p for p, q in zip(a, x, strict=True)] for x in (b, c))
    cross = [u[1] * v[2] - u[2] * v[1], u[2] * v[0] - u[0] * v[2], u[0] * v[1] - u[1] * v[0]]
    size = norm(cross)
    n = canonical_plane_normal(cross)
    plane = F.struct(*[x.alias(k) for x, k in zip(n, ("nx", "ny", "nz"), strict=True)], dot(n, a).alias("offset"))
    return F.when((size > 1e-8) & (size < math.inf), plane)


def plane_class(alignment: Column, height: Column, floor: Column, is_floor: Column, degrees: float = 25.0, room_height: float = 1.8) -> Column:
    """(name, quarantined) of a plane from |normal . up|: floor, ceiling, wall or clutter."""
    level = F.abs(alignment) >= math.cos(math.radians(degrees))
    upright = F.abs(alignment) <= math.sin(math.radians(degrees))
    name = F.when(level & is_floor, "floor").when(level & (height - floor >= room_height), "ceiling").when(~level & upright, "wall").otherwise("clutter")
    return F.struct(name.alias("name"), (name == "clutter").alias("quarantined"))


def in_wall_band(height: Column, upness: Column, floor: Column, ceiling: Column, margin: float = 0.35) -> Column:
    """Whether a point is between floor and ceiling and its normal is level; a null ceiling was not seen."""
    upper = F.coalesce(ceiling - margin, floor + 1.9)
    return (height > floor + margin) & (height < upper) & (F.abs(upness) < 0.35)


def lines_meet(p: list[Column], d: list[Column], q: list[Column], e: list[Column], least: float = 1e-9) -> tuple[Column, Column, Column]:
    """(x, y, t): where the lines p + t * d and q + s * e meet; null where they are as good as parallel."""
    det = d[0] * e[1] - d[1] * e[0]
    t = F.when(F.abs(det) >= least, ((q[0] - p[0]) * e[1] - (q[1] - p[1]) * e[0]) / det)
    return p[0] + d[0] * t, p[1] + d[1] * t, t


def walls_meet(p: list[Column], d: list[Column], q: list[Column], e: list[Column]) -> Column:
    """(x, y, ta, tb): where two walls' lines meet and how far along each; null below a sine of 0.15."""
    x, y, t = lines_meet(p, d, q, e, 0.15)
    return F.when(t.isNotNull(), F.struct(x.alias("x"), y.alias("y"), t.alias("ta"), along([x, y], q, e).alias("tb")))


def ray_crosses(camera: list[Column], target: list[Column], start: list[Column], end: list[Column], margin: Column) -> Column:
    """Whether the ray passes the wall well inside both: between 0.02 and 0.98 of the ray, margin and 1 - margin of the wall."""
    ray, wall = ([b - a for a, b in zip(x, y, strict=True)] for x, y in ((camera, target), (start, end)))
    det = ray[0] * wall[1] - ray[1] * wall[0]
    diff = [a - b for a, b in zip(start, camera, strict=True)]
    safe = F.when(F.abs(det) >= 1e-9, det)
    t = (diff[0] * wall[1] - diff[1] * wall[0]) / safe
    s = (diff[0] * ray[1] - diff[1] * ray[0]) / safe
    return F.coalesce((t > 0.02) & (t < 0.98) & (s > margin) & (s < 1 - margin), F.lit(False))


def room_height_at(floor: tuple[list[Column], Column], ceiling: tuple[list[Column], Column], foot: list[Column], up: list[Column]) -> Column:
    """Height of the ceiling plane over the floor plane above a point at height 0; null if a plane is steep or it is not positive."""
    nf, nc = ([c / F.greatest(norm(n), F.lit(1e-9)) for c in n] for n, _ in (floor, ceiling))
    uf, uc = dot(nf, up), dot(nc, up)
    h = (floor[1] - dot(nf, foot)) / F.when(F.abs(uf) > 0.1, uf)
    base = [p + h * u for p, u in zip(foot, up, strict=True)]
    out = (ceiling[1] - dot(nc, base)) / F.when(F.abs(uc) > 0.1, uc)
    return F.when((out > 0) & (out < math.inf), out)


def edge_line(a: list[Column], b: list[Column], outward: Column) -> Column:
    """(nx, ny, offset): the line of an edge moved outward, to the right of its direction."""
    d = [y - x for x, y in zip(a, b, strict=True)]
    size = norm(d)
    ok = size > 1e-9
    n = [d[1] / size, -d[0] / size]
    return F.struct(F.when(ok, n[0]).otherwise(1.0).alias("nx"), F.when(ok, n[1]).otherwise(0.0).alias("ny"), F.when(ok, dot(n, a) + outward).otherwise(0.0).alias("offset"))


def offset_polygon(polygon: Column, distances: Column) -> Column:
    """The polygon's vertices after each edge i moved outward by distances[i]; counter-clockwise.

    polygon is an array of structs (x, y).  Where neighbouring edges are parallel the vertex moves
    along the mean of their normals.
    """
    from .geometry import signed_area

    turned = signed_area(polygon) < 0
    polygon = F.when(turned, F.reverse(polygon)).otherwise(polygon)
    distances = F.when(turned, F.reverse(distances)).otherwise(distances)
    after = F.concat(F.slice(polygon, 2, F.size(polygon) - 1), F.slice(polygon, 1, 1))
    joined = F.arrays_zip(polygon.alias("p"), after.alias("q"), distances.alias("d"))
    lines = F.transform(joined, lambda e: edge_line([e["p"]["x"], e["p"]["y"]], [e["q"]["x"], e["q"]["y"]], e["d"]))
    before = F.concat(F.slice(lines, -1, 1), F.slice(lines, 1, F.size(lines) - 1))
    corner = F.arrays_zip(before.alias("u"), lines.alias("v"), polygon.alias("p"), distances.alias("d"))

    def vertex(c: Column) -> Column:
        u, v = c["u"], c["v"]
        det = u["nx"] * v["ny"] - u["ny"] * v["nx"]
        flat = F.abs(det) <= 1e-8
        x = F.when(flat, c["p"]["x"] + (u["nx"] + v["nx"]) * 0.5 * c["d"]).otherwise((u["offset"] * v["ny"] - v["offset"] * u["ny"]) / det)
        y = F.when(flat, c["p"]["y"] + (u["ny"] + v["ny"]) * 0.5 * c["d"]).otherwise((u["nx"] * v["offset"] - v["nx"] * u["offset"]) / det)
        return F.struct(x.alias("x"), y.alias("y"))

    return F.transform(corner, vertex)


def geometry_key(normal: list[Column], offset: Column, start: list[Column], end: list[Column]) -> list[Column]:
    """What orders walls that tie: normal, offset and ends to eight places."""
    s = canonical_sign(*normal)
    return [F.round(s * c, 8) for c in normal] + [F.round(c, 8) for c in (offset, *start, *end)]


def fit_rank(inliers: Column, length: Column, rms: Column, key: list[Column]) -> list[Column]:
    """Order in which walls are fitted: best supported, longest, tightest first."""
    return [inliers.desc(), F.round(length, 8).desc(), F.round(rms, 8).asc(), *[k.asc() for k in key]]


def output_rank(inliers: Column, length: Column, key: list[Column]) -> list[Column]:
    """Order in which walls are put out: longest first."""
    return [F.round(length, 8).desc(), inliers.desc(), *[k.asc() for k in key]]


def plan_cell(u: Column, v: Column, resolution: float) -> list[Column]:
    return [F.floor(u / resolution).cast("long"), F.floor(v / resolution).cast("long")]
