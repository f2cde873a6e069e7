"""Cycles of a successor relation, faces of wall graphs and outlines of labelled cells.

Members of a ring that meet in one Arrow batch become one link of it; a ring that is whole there is done.
Across batches a ring is found by pointer doubling: every link knows the least link within 1, 2, 4, ...
steps and how far ahead it is, so a ring of n links is labelled and ordered in log n joins, whichever
captures it belongs to and however long it is.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..functions.frames import along, lines_meet
from ..functions.geometry import point_in_polygon
from .graphs import checkpointed, components, written


def _linked(n: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(last, back, size, whole) of rows with numbers n and successors `after`: the last row of a row's link, the steps to it, the link's rows.

    A link goes on until its successor is in no row here.  One that comes back to itself is whole, and ends before its least number.
    """
    rows, order = np.arange(len(n)), np.argsort(n)
    at = order[np.minimum(np.searchsorted(n, after, sorter=order), len(n) - 1)]
    inside = n[at] == after
    to = np.where(inside, at, rows)
    doublings = range(len(n).bit_length())
    low, hop = n, to
    for _ in doublings:
        low, hop = np.minimum(low, low[hop]), hop[hop]
    whole = inside[hop]
    last = np.where(whole & (after == low), rows, to)
    back = (last != rows).astype(np.int64)
    for _ in doublings:
        back, last = back + back[last], last[last]
    return last, back, np.bincount(last, minlength=len(n))[last].astype(np.int64), whole


def _ringed(steps: DataFrame, rounds: int = 60) -> DataFrame:
    """steps(n, next, ...), n to next a permutation of longs, with ring, a number of the row's cycle, size, and place, the steps from one row of the cycle to this one.

    Rows that follow each other should be near in the partitions of `steps`; rounds then move few links.  Joins are
    shuffle joins: files that Spark takes for small enough to broadcast are many times larger in memory.
    """

    def link(batches):
        for b in batches:
            if b.num_rows:
                n, after = (b.column(c).to_numpy() for c in ("n", "next"))
                last, back, size, whole = _linked(n, after)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(n[last]), pa.array(back), pa.array(size), pa.array(after[last], mask=whole)], names=[*b.schema.names, "tail", "back", "size", "exit"])

    x = written(steps.mapInArrow(link, StructType([*steps.schema.fields, *[StructField(c, LongType()) for c in ("tail", "back", "size", "exit")]])))
    out = lambda df, ring, ahead, size: df.select(*steps.columns, F.col(ring).alias("ring"), F.pmod(F.col(size) - 1 - ahead, F.col(size)).alias("place"), F.col(size).alias("size"))
    done = out(x.where("exit is null"), "tail", F.col("back"), "size")
    links = written(x.where("exit is not null and back = size - 1").select(F.col("n").alias("head"), "tail", "exit", "size"))
    if links.isEmpty():
        return done
    join = lambda a, b, on: a.hint("merge").join(b.hint("merge"), on)
    nexts = links.select(F.col("head").alias("exit"), F.col("tail").alias("jump"), F.col("size").alias("span"))
    y = written(join(links.select("tail", "exit"), nexts, "exit").select("tail", "jump", "span", F.col("tail").alias("low"), F.lit(0).cast("long").alias("ahead"), F.lit(True).alias("moved")))
    for _ in range(rounds):
        far = y.select(F.col("tail").alias("jump"), F.col("jump").alias("then"), F.col("span").alias("over"), F.col("low").alias("far"), F.col("ahead").alias("more"))
        lower = F.col("far") < F.col("low")
        y = written(join(y, far, "jump").select("tail", F.col("then").alias("jump"), (F.col("span") + F.col("over")).alias("span"), F.least("low", "far").alias("low"), F.when(lower, F.col("span") + F.col("more")).otherwise(F.col("ahead")).alias("ahead"), lower.alias("moved")), y)
        if y.where("moved").isEmpty():  # no window saw a lesser link than the one behind it, so all have seen their ring
            break
    else:
        raise RuntimeError(f"a ring has more than 2^{rounds} links")
    whole = join(links.select("tail", "size"), y.select("tail", "low"), "tail").groupBy("low").agg(F.sum("size").alias("members"))
    found = join(join(y.select("tail", "low", "ahead"), whole, "low"), x.where("exit is not null").drop("exit", "size"), "tail")
    return done.unionByName(out(found, "low", F.col("back") + F.col("ahead"), "members"))


def ring_order(steps: DataFrame) -> DataFrame:
    """(id, ring, place) of steps(id, next), a permutation: ring is the cycle's least id, place the steps from it to this one.

    Ids are numbered in their order first, so that rounds move numbers and not ids, which may be wide.
    """
    one = F.monotonically_increasing_id()
    names = written(steps.select("id", "next").repartitionByRange("id").sortWithinPartitions("id").select("id", "next", one.alias("n")))
    nexts = names.select(F.col("id").alias("next"), F.col("n").alias("after"))
    x = names.hint("merge").join(nexts.hint("merge"), "next").select("n", F.col("after").alias("next"), "id")
    x = _ringed(x.repartition(F.shiftright("n", 13)).sortWithinPartitions("n"))
    least = x.groupBy("ring").agg(F.min_by(F.struct("id", "place"), "n").alias("least"))
    return x.hint("merge").join(least.hint("merge"), "ring").select("id", F.col("least.id").alias("ring"), F.pmod(F.col("place") - F.col("least.place"), F.col("size")).alias("place"))


def _squares(walls: DataFrame, scene: str, side: float, margin: float) -> DataFrame:
    """walls with the squares (cu, cv) that each, widened by the margin, passes; no square of its box besides."""
    low, high = F.least("x0", "x1"), F.greatest("x0", "x1")
    x = walls.withColumn("cu", F.explode(F.sequence(F.floor((low - margin) / side), F.floor((high + margin) / side))))
    slope = F.when(high - low > 1e-12, (F.col("y1") - F.col("y0")) / (F.col("x1") - F.col("x0")))
    at = lambda u: F.col("y0") + (F.least(F.greatest(u, low), high) - F.col("x0")) * slope
    ends = [F.coalesce(at(F.col("cu") * side - margin), F.col("y0")), F.coalesce(at((F.col("cu") + 1) * side + margin), F.col("y1"))]
    rows = F.sequence(F.floor((F.least(*ends) - margin) / side), F.floor((F.greatest(*ends) + margin) / side))
    return x.withColumn("cv", F.explode(rows))


def wall_stops(walls: DataFrame, scene: str, tolerance: float = 0.08, side: float = 2.0) -> DataFrame:
    """(scene, wall, t, x, y): a wall's ends, where others cross it, and others' ends that come nearer than the tolerance.

    walls(scene, wall, x0, y0, x1, y1); t is in metres from the wall's start.  Walls are compared where
    they pass a common square; positions are rounded to nine places.
    """
    length = F.hypot(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    finite = " and ".join(f"{c} is not null and not isnan({c}) and abs({c}) < double('infinity')" for c in ("x0", "y0", "x1", "y1"))
    w = walls.where(finite).select(scene, "wall", "x0", "y0", "x1", "y1").withColumn("length", length).where("length > 1e-6")
    w = w.withColumn("dx", F.try_divide(F.col("x1") - F.col("x0"), F.col("length"))).withColumn("dy", F.try_divide(F.col("y1") - F.col("y0"), F.col("length")))
    shape = ["x0", "y0", "x1", "y1", "dx", "dy", "length"]
    at = _squares(w, scene, side, tolerance)
    others = at.withColumnsRenamed({"wall": "other"} | {c: f"o{c}" for c in shape})
    # walls that share several squares give a stop in each of them, and it goes with the rows that are the same
    x = at.hint("merge").join(others.hint("merge"), [scene, "cu", "cv"]).where("wall <> other")
    v = lambda *n: [F.col(c) for c in n]
    mx, my, t = lines_meet(v("x0", "y0"), v("dx", "dy"), v("ox0", "oy0"), v("odx", "ody"))
    s = along([mx, my], v("ox0", "oy0"), v("odx", "ody"))
    stop = lambda ok, t, x, y: F.when(ok, F.struct(t.alias("t"), x.alias("x"), y.alias("y")))
    crossing = stop((t >= -1e-9) & (t <= F.col("length") + 1e-9) & (s >= -1e-9) & (s <= F.col("olength") + 1e-9), t, mx, my)

    def end(n: str) -> Column:
        p = v(f"ox{n}", f"oy{n}")
        on, off = along(p, v("x0", "y0"), v("dx", "dy")), F.abs((p[0] - F.col("x0")) * F.col("dy") - (p[1] - F.col("y0")) * F.col("dx"))
        return stop((on >= 0) & (on <= F.col("length")) & (off < tolerance), on, *p)

    met = x.select(scene, "wall", F.explode(F.array_compact(F.array(crossing, end("0"), end("1")))).alias("p"))
    own = w.select(scene, "wall", F.explode(F.array(stop(F.lit(True), F.lit(0.0), *v("x0", "y0")), stop(F.lit(True), F.col("length"), *v("x1", "y1")))).alias("p"))
    return own.unionByName(met).select(scene, "wall", "p.t", F.round("p.x", 9).alias("x"), F.round("p.y", 9).alias("y")).distinct()


def _merged(nodes: DataFrame, scene: str, tolerance: float) -> DataFrame:
    """(scene, x, y, nx, ny) of nodes that move: those nearer to each other than the tolerance, in chains, become the first of them."""
    side, reach = 4 * tolerance, 1.001 * tolerance
    cell = lambda c, by=0.0: F.floor((F.col(c) + by) / side)
    a = nodes.select(scene, F.col("x").alias("ax"), F.col("y").alias("ay"), cell("x").alias("cu"), cell("y").alias("cv"))
    # the first of two nodes is not to the right of the other, which goes to the cells that it may be in
    b = nodes.select(scene, F.col("x").alias("bx"), F.col("y").alias("by"), F.explode(F.sequence(cell("x", -reach), cell("x"))).alias("cu"))
    b = b.withColumn("cv", F.explode(F.sequence(F.floor((F.col("by") - reach) / side), F.floor((F.col("by") + reach) / side))))
    near = (F.hypot(F.col("ax") - F.col("bx"), F.col("ay") - F.col("by")) < tolerance) & (F.struct("ax", "ay") < F.struct("bx", "by"))
    name = lambda x, y: F.struct(F.col(scene).alias("s"), F.col(x).alias("x"), F.col(y).alias("y"))
    edges = checkpointed(a.hint("merge").join(b.hint("merge"), [scene, "cu", "cv"]).where(near).select(name("ax", "ay").alias("a"), name("bx", "by").alias("b")))
    ids = edges.select(F.col("a").alias("id")).unionByName(edges.select(F.col("b").alias("id"))).distinct()
    return components(ids, edges).where("id <> label").select(F.col("id.s").alias(scene), "id.x", "id.y", F.col("label.x").alias("nx"), F.col("label.y").alias("ny"))


def wall_graph(walls: DataFrame, scene: str, tolerance: float = 0.08) -> DataFrame:
    """(scene, a, b): the edges between neighbouring nodes of the walls of scenes with three walls or more; a < b are points (x, y)."""
    stops = checkpointed(wall_stops(walls, scene, tolerance))
    enough = stops.select(scene, "wall").distinct().groupBy(scene).count().where("count >= 3").select(scene)
    stops = stops.join(enough, scene, "left_semi")
    moved = _merged(stops.select(scene, "x", "y").distinct(), scene, tolerance)
    x = stops.join(moved, [scene, "x", "y"], "left").select(scene, "wall", "t", F.struct(F.coalesce("nx", "x").alias("x"), F.coalesce("ny", "y").alias("y")).alias("p"))
    after = F.lead("p").over(Window.partitionBy(scene, "wall").orderBy("t", "p"))
    return x.withColumn("q", after).where("q is not null and p <> q").select(scene, F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()


def _faced(edges: DataFrame, scene: str, side: float = 64.0) -> DataFrame:
    """(scene, p, q, ring, place, size): each of edges(scene, a, b) in both directions, with the cycle to its left.

    Edges are dealt over tasks by squares of `side`, so that most of a cycle is in one task, but no large capture is.
    """
    way = lambda p, q, n, twin: F.struct(F.col(p).alias("p"), F.col(q).alias("q"), F.col(n).alias("own"), F.col(twin).alias("twin"))
    numbered = edges.select(scene, "a", "b", (2 * F.monotonically_increasing_id()).alias("i")).withColumn("j", F.col("i") + 1)
    both = numbered.select(scene, F.explode(F.array(way("a", "b", "i", "j"), way("b", "a", "j", "i"))).alias("e")).select(scene, "e.*")
    square = lambda c: F.round(F.col(f"p.{c}") / side).cast("long")  # noqa: E731 - as a double it would be shuffled once more
    both = both.withColumn("su", square("x")).withColumn("sv", square("y")).repartition(scene, "su", "sv")
    around = Window.partitionBy(scene, "su", "sv", "p").orderBy(F.atan2(F.col("q.y") - F.col("p.y"), F.col("q.x") - F.col("p.x")), "q")
    whole = around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # arriving at p from q, go on to the next neighbour clockwise
    turn = F.coalesce(F.lag("own").over(around), F.last("own").over(whole))
    return _ringed(both.select(F.col("twin").alias("n"), turn.alias("next"), scene, F.col("q").alias("p"), F.col("p").alias("q"))).drop("n", "next")


def wall_faces(walls: DataFrame, scene: str, least: float = 1.4, tolerance: float = 0.08) -> DataFrame:
    """(scene, face, area, cx, cy, polygon, holes, reason): the bounded faces of each scene's walls, accepted or not.

    walls(scene, wall, x0, y0, x1, y1), none of them quarantined.  Walls are cut where they meet; ends and
    crossings nearer than the tolerance become one node.  What bounds the same face on both sides, dangling
    ends and bridges, bounds nothing and goes.  A part of the graph that lies inside a face is a hole in
    it, not counted in its area and centroid.  Faces below `least` have the reason `below-min-area`, other
    faces are numbered from 0 by centroid and area; polygon is counter-clockwise, an array of structs (x, y).
    """
    edges = checkpointed(wall_graph(walls, scene, tolerance))
    halves = _faced(edges, scene)
    sides = halves.groupBy(scene, F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).agg((F.min("ring") == F.max("ring")).alias("same"))
    kept = checkpointed(sides.where("not same").select(scene, "a", "b"))
    if kept.count() < edges.count():
        halves = _faced(kept, scene)
    cross = F.col("p.x") * F.col("q.y") - F.col("q.x") * F.col("p.y")
    moment = lambda c: F.sum((F.col(f"p.{c}") + F.col(f"q.{c}")) * cross) / 6
    corners = F.transform(F.array_sort(F.collect_list(F.struct("place", "p"))), lambda c: c["p"])
    rings = halves.groupBy(scene, "ring").agg((F.sum(cross) / 2).alias("area"), moment("x").alias("mx"), moment("y").alias("my"), corners.alias("corners"), F.min(F.struct("p", "q", "place")).alias("least"))
    # a ring is known by its least side, and starts there
    start, n = F.col("least.place").cast("int"), F.size("corners")
    polygon = F.concat(F.slice("corners", start + 1, n - start), F.slice("corners", F.lit(1), start))
    rings = checkpointed(rings.select(scene, F.struct("least.p", "least.q").alias("ring"), "area", "mx", "my", polygon.alias("polygon"), F.col("least.p").alias("first")))
    shells, outer = rings.where("area > 1e-9"), rings.where("area < -1e-9")
    # the outer ring of a part of the graph is a hole of the smallest face around its first point
    side = 4.0
    span = lambda c: F.sequence(F.floor(F.array_min(F.col("polygon")[c]) / side), F.floor(F.array_max(F.col("polygon")[c]) / side))
    boxes = shells.select(scene, F.col("ring").alias("shell"), F.col("area").alias("around"), "polygon", F.explode(span("x")).alias("cu")).select("*", F.explode(span("y")).alias("cv"))
    points = outer.select(scene, "ring", "area", "mx", "my", F.col("polygon").alias("hole"), "first", F.floor(F.col("first.x") / side).alias("cu"), F.floor(F.col("first.y") / side).alias("cv"))
    held = points.hint("merge").join(boxes.hint("merge"), [scene, "cu", "cv"]).where(point_in_polygon(F.col("first.x"), F.col("first.y"), F.col("polygon")) & ~F.array_contains("polygon", F.col("first")))
    held = held.groupBy(scene, "ring").agg(F.min_by(F.struct("shell", "area", "mx", "my", "hole"), F.struct("around", "shell")).alias("h"))
    holes = held.groupBy(scene, F.col("h.shell").alias("ring")).agg(F.sum("h.area").alias("ha"), F.sum("h.mx").alias("hx"), F.sum("h.my").alias("hy"), F.array_sort(F.collect_list("h.hole")).alias("holes"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    x = shells.join(holes, [scene, "ring"], "left").withColumn("net", F.col("area") + zero("ha")).where("net > 1e-9")
    x = x.select(scene, F.col("net").alias("area"), ((F.col("mx") + zero("hx")) / F.col("net")).alias("cx"), ((F.col("my") + zero("hy")) / F.col("net")).alias("cy"), "polygon", F.coalesce("holes", F.array().cast("array<array<struct<x: double, y: double>>>")).alias("holes"))
    reason = F.when(F.col("area") < least, "below-min-area")
    place = F.row_number().over(Window.partitionBy(scene, reason).orderBy(F.round("cx", 8), F.round("cy", 8), F.round("area", 8), "polygon")) - 1
    return x.withColumn("reason", reason).withColumn("face", F.when(F.col("reason").isNull(), place)).select(scene, "face", "area", "cx", "cy", "polygon", "holes", "reason")


#: Sides of a cell (direction, corner that it starts from, neighbour across), counter-clockwise, so that the cell is to the left.
_SIDES = ((0, (0, 0), (0, -1)), (1, (1, 0), (1, 0)), (2, (1, 1), (0, 1)), (3, (0, 1), (-1, 0)))
_STEPS = ((1, 0), (0, 1), (-1, 0), (0, -1))


def outline_rings(cells: DataFrame, by: list[str]) -> DataFrame:
    """(by, ring, n, area, points, corners): the closed outlines of each group's cells(by, cu, cv), n cell sides long.

    The group's cells are to the left, so an outer outline has a positive area, a hole a negative one, and a group's areas
    add up to its number of cells.  Cells that touch at a corner only are not joined there.  points are the
    middles of the sides, in cell middles: what marching squares at half give; corners are where they start.
    """
    cells = checkpointed(cells.select(*by, F.col("cu").cast("long").alias("cu"), F.col("cv").cast("long").alias("cv")).distinct())
    side = F.explode(F.array(*[F.struct(F.lit(d).alias("d"), *[F.lit(v).cast("long").alias(k) for k, v in zip(("x", "y", "u", "v"), (*corner, *beside), strict=True)]) for d, corner, beside in _SIDES]))
    x = cells.withColumn("s", side).select(*by, (F.col("cu") + F.col("s.x")).alias("x"), (F.col("cv") + F.col("s.y")).alias("y"), F.col("s.d").alias("d"), (F.col("cu") + F.col("s.u")).alias("nu"), (F.col("cv") + F.col("s.v")).alias("nv"))
    x = checkpointed(x.join(cells.withColumnsRenamed({"cu": "nu", "cv": "nv"}), [*by, "nu", "nv"], "left_anti").select(*by, "x", "y", "d"))
    at = lambda k: F.element_at(F.array(*[F.lit(s[k]).cast("long") for s in _STEPS]), F.col("d") + 1)
    ends = x.select(*by, F.col("x").alias("sx"), F.col("y").alias("sy"), "d", (F.col("x") + at(0)).alias("x"), (F.col("y") + at(1)).alias("y"))
    out = x.groupBy(*by, "x", "y").agg(F.expr("bit_or(1 << d)").alias("out"))
    way = lambda turn: F.pmod(F.col("d") + turn, F.lit(4))
    there = lambda turn: F.expr(f"(out >> pmod(d + {turn}, 4)) & 1") == 1
    follow = F.when(there(1), way(1)).when(there(0), way(0)).otherwise(way(3))  # left first: the same cell goes on
    name = lambda x, y, d: F.struct(*by, F.col(x).alias("x"), F.col(y).alias("y"), d.cast("int").alias("d"))
    steps = ends.join(out, [*by, "x", "y"]).select(name("sx", "sy", F.col("d")).alias("id"), name("x", "y", follow).alias("next"))
    x = ring_order(steps).select("ring", "place", "id.x", "id.y", "id.d")
    # a side's middle, in cell middles: half a cell beyond its corner, half a step on
    x = x.withColumn("mx", F.col("x") - 0.5 + at(0) / 2).withColumn("my", F.col("y") - 0.5 + at(1) / 2)
    area = F.sum(F.col("x") * at(1) - F.col("y") * at(0)) / 2
    points = F.transform(F.array_sort(F.collect_list(F.struct("place", F.col("mx").alias("x"), F.col("my").alias("y")))), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
    corners = F.transform(F.array_sort(F.collect_list(F.struct("place", "x", "y"))), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
    rings = x.groupBy("ring").agg(F.count("*").alias("n"), area.alias("area"), points.alias("points"), corners.alias("corners"))
    return rings.select(*[F.col(f"ring.{b}").alias(b) for b in by], F.struct("ring.x", "ring.y", "ring.d").alias("ring"), "n", "area", "points", "corners")


def _thinned(p: np.ndarray, tolerance: float) -> np.ndarray:
    """A line's ends and, again and again, the point farthest from the chord between two kept ones, if beyond the tolerance."""
    keep, todo = {0, len(p) - 1}, [(0, len(p) - 1)]
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        chord, rest = p[b] - p[a], p[a + 1 : b] - p[a]
        size = chord @ chord
        t = np.clip(rest @ chord / size, 0, 1) if size > 0 else np.zeros(len(rest))
        away = np.hypot(*(rest - t[:, None] * chord).T)
        k = int(np.argmax(away))
        if away[k] > tolerance:
            keep.add(a + 1 + k)
            todo += [(a, a + 1 + k), (a + 1 + k, b)]
    return p[sorted(keep)]


def simplified(points: Column, tolerance: float = 1.5) -> Column:
    """A closed outline without the points that stray at most `tolerance` from it; it starts where it did."""

    @F.pandas_udf("array<struct<x: double, y: double>>")
    def thin(rings: pd.Series) -> pd.Series:
        out = []
        for ring in rings:
            p = np.array([(v["x"], v["y"]) for v in ring], float).reshape(-1, 2)
            p = _thinned(np.vstack([p, p[:1]]), tolerance)[:-1] if len(p) else p
            out.append([{"x": x, "y": y} for x, y in p.tolist()])
        return pd.Series(out)

    return thin(points)


def rectified(polygon: Column, snap: float = 32.0, least: float = 0.25) -> Column:
    """A polygon of straight edges and sharp corners: edges near an axis are turned onto it about their middles.

    Edges shorter than `least` are left out, neighbours of one direction become one line by length, and corners are where
    neighbouring lines meet.  With fewer than three edges or lines the polygon stays as it is.
    """
    line = "struct<dx: double, dy: double, x: double, y: double, w: double>"
    after = F.concat(F.slice(polygon, 2, F.greatest(F.size(polygon) - 1, F.lit(0))), F.slice(polygon, 1, 1))

    def edge(e: Column) -> Column:
        dx, dy = e["q"]["x"] - e["p"]["x"], e["q"]["y"] - e["p"]["y"]
        length = F.hypot(dx, dy)
        angle = F.degrees(F.atan2(F.abs(dy), F.abs(dx)))
        flat, steep = angle < snap, angle > 90 - snap
        d = [F.when(flat, 1.0).when(steep, 0.0).otherwise(dx / length), F.when(flat, 0.0).when(steep, 1.0).otherwise(dy / length)]
        return F.struct(d[0].alias("dx"), d[1].alias("dy"), ((e["p"]["x"] + e["q"]["x"]) / 2).alias("x"), ((e["p"]["y"] + e["q"]["y"]) / 2).alias("y"), length.alias("w"))

    def one(a: Column, b: Column) -> Column:
        w = a["w"] + b["w"]
        return F.struct(a["dx"].alias("dx"), a["dy"].alias("dy"), *[((a[c] * a["w"] + b[c] * b["w"]) / w).alias(c) for c in "xy"], w.alias("w"))

    same = lambda a, b: F.abs(a["dx"] * b["dx"] + a["dy"] * b["dy"]) > 0.999
    last = lambda m: F.element_at(m, -1)
    butlast = lambda m: F.slice(m, 1, F.size(m) - 1)
    edges = F.filter(F.transform(F.arrays_zip(polygon.alias("p"), after.alias("q")), edge), lambda e: e["w"] >= least)
    joined = F.aggregate(edges, F.array().cast(f"array<{line}>"), lambda m, e: F.when((F.size(m) > 0) & same(F.get(m, F.size(m) - 1), e), F.concat(butlast(m), F.array(one(last(m), e)))).otherwise(F.concat(m, F.array(e))))
    # the last may go on as the first; the array is bound once by a transform of one element
    closed = F.transform(F.array(joined), lambda m: F.when((F.size(m) > 2) & same(m[0], last(m)), F.concat(F.array(one(m[0], last(m))), F.slice(m, 2, F.size(m) - 2))).otherwise(m))[0]

    def corner(c: Column) -> Column:
        a, b = c["a"], c["b"]
        x, y, _ = lines_meet([a["x"], a["y"]], [a["dx"], a["dy"]], [b["x"], b["y"]], [b["dx"], b["dy"]])
        return F.struct(F.coalesce(x, b["x"]).alias("x"), F.coalesce(y, b["y"]).alias("y"))

    def corners(m: Column) -> Column:
        return F.transform(F.arrays_zip(m.alias("a"), F.concat(F.slice(m, 2, F.greatest(F.size(m) - 1, F.lit(0))), F.slice(m, 1, 1)).alias("b")), corner)

    return F.transform(F.array(F.struct(edges.alias("e"), closed.alias("m"))), lambda s: F.when((F.size(s["e"]) < 3) | (F.size(s["m"]) < 3), polygon).otherwise(corners(s["m"])))[0]


def outlines(cells: DataFrame, by: list[str], resolution: float, origin: tuple[float, float] = (0.0, 0.0), snap: float = 32.0) -> DataFrame:
    """(by, area, polygon): the rectified plan outline of each group's cells, and its area.

    The group's longest outline is thinned to 1.5 cells, put on the plan and rectified.  The area is the polygon's if that
    is from 0.6 to 1.6 times the cells', else the cells'.
    """
    rings = outline_rings(cells, by)
    count = rings.groupBy(*by).agg((F.sum("area") * resolution * resolution).alias("cells"), F.max_by("points", F.struct("n", "area", "ring")).alias("points"))
    on_plan = F.transform(simplified(F.col("points")), lambda p: F.struct(*[(origin[i] + (p[c] + 0.5) * resolution).alias(c) for i, c in enumerate("xy")]))
    x = count.withColumn("raw", on_plan).withColumn("polygon", F.when(F.size("raw") < 4, F.col("raw")).otherwise(rectified(F.col("raw"), snap)))
    from ..functions.geometry import signed_area

    own = F.abs(signed_area(F.col("polygon")))
    return x.withColumn("own", own).select(*by, F.when(F.col("own").between(0.6 * F.col("cells"), 1.6 * F.col("cells")), F.col("own")).otherwise(F.col("cells")).alias("area"), "polygon")
