"""Sparse grids: a row per cell that holds something, absent rows are 0."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graphs import components


def histogram(df: DataFrame, keys: list[str], cu: Column, cv: Column) -> DataFrame:
    """(keys, cu, cv, n): counts per cell; rows without a cell are dropped."""
    cells = df.select(*keys, cu.cast("long").alias("cu"), cv.cast("long").alias("cv")).where("cu is not null and cv is not null")
    return cells.groupBy(*keys, "cu", "cv").agg(F.count("*").alias("n"))


def hits_and_near(df: DataFrame, keys: list[str], cu: Column, cv: Column, distance: Column, plane: float, near: float) -> DataFrame:
    """Two histograms in one pass: points on the plane, and points near it."""
    x = df.select(*keys, cu.alias("cu"), cv.alias("cv"), F.abs(distance).alias("d"))
    out = x.groupBy(*keys, "cu", "cv").agg(F.count_if(F.col("d") < plane).alias("hits"), F.count_if((F.col("d") >= plane) & (F.col("d") < near)).alias("near"))
    return out.where("hits > 0 or near > 0")


#: Masks of a tile's bits 8 * (cu & 7) + (cv & 7): its first and last cells along cu and along cv.
_FIRST, _LAST = {"tu": 0xFF, "tv": 0x0101010101010101}, {"tu": 0xFF << 56, "tv": 0x0101010101010101 << 7}


def _tiles(cells: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, tu, tv, mask): cells as the bits of tiles of 8 by 8."""
    cu, cv = F.col("cu").cast("long"), F.col("cv").cast("long")
    bit = (cu.bitwiseAND(F.lit(7)) * 8 + cv.bitwiseAND(F.lit(7))).cast("int")
    x = cells.where("cu is not null and cv is not null").select(*keys, F.shiftright(cu, 3).alias("tu"), F.shiftright(cv, 3).alias("tv"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("mask"))
    return x.groupBy(*keys, "tu", "tv").agg(F.bit_or("mask").alias("mask"))


def _untiled(tiles: DataFrame, keys: list[str]) -> DataFrame:
    bits = F.filter(F.array(*[F.lit(b) for b in range(64)]), lambda b: F.call_function("shiftrightunsigned", F.col("mask"), b).bitwiseAND(F.lit(1)) == 1)
    x = tiles.select(*keys, "tu", "tv", F.explode(bits).alias("b"))
    return x.select(*keys, (F.col("tu") * 8 + F.shiftright("b", 3)).alias("cu"), (F.col("tv") * 8 + F.col("b").bitwiseAND(F.lit(7))).alias("cv"))


def _stepped(tiles: DataFrame, keys: list[str], r: int, whole: bool) -> DataFrame:
    """tiles after r steps along both axes: cells beside a cell, or, if whole, cells whose neighbours are all there.

    A step hands a tile its own bits, shifted either way, and the bits that come over from the two tiles beside it.
    """
    signed = lambda v: F.lit(v - (1 << 64) if v >> 63 else v).cast("long")
    m, none = F.col("mask"), F.lit(0).cast("long")
    for axis in ["tu", "tv"] * r:
        by = 8 if axis == "tu" else 1
        low, high = m.bitwiseAND(signed(_FIRST[axis])), m.bitwiseAND(signed(_LAST[axis]))
        up, down = F.shiftleft(m.bitwiseXOR(high), by), F.shiftrightunsigned(m.bitwiseXOR(low), by)
        part = lambda d, own, up, down: F.struct(F.lit(d).alias("d"), own.alias("own"), up.alias("up"), down.alias("down"))
        parts = F.array(part(0, m, up, down), part(1, none, F.shiftrightunsigned(high, 7 * by), none), part(-1, none, none, F.shiftleft(low, 7 * by)))
        x = tiles.select(*keys, "tu", "tv", F.explode(parts).alias("p")).where("p.own <> 0 or p.up <> 0 or p.down <> 0").withColumn(axis, F.col(axis) + F.col("p.d"))
        x = x.repartition(*keys, "tu", "tv")  # a task's parts seldom share a tile: merging them before would only hold them all
        x = x.groupBy(*keys, "tu", "tv").agg(*[F.bit_or(f"p.{c}").alias(c) for c in ("own", "up", "down")])
        tiles = x.select(*keys, "tu", "tv", F.expr("own & up & down" if whole else "own | up | down").alias("mask")).where("mask <> 0")
    return tiles


def _chained(cells: DataFrame, keys: list[str], *steps: tuple[int, bool]) -> DataFrame:
    """cells after steps (r, whole), one after another; tiles become cells only at the end."""
    tiles = _tiles(cells, keys)
    for r, whole in steps:
        tiles = _stepped(tiles, keys, r, whole)
    return _untiled(tiles, keys)


def dilate(cells: DataFrame, keys: list[str], r: int = 1) -> DataFrame:
    """Cells within r steps in both directions of a cell."""
    return _chained(cells, keys, (r, False))


def erode(cells: DataFrame, keys: list[str], r: int = 1) -> DataFrame:
    """Cells whose whole neighbourhood of r steps is there."""
    return _chained(cells, keys, (r, True))


def close(cells: DataFrame, keys: list[str], r: int = 1) -> DataFrame:
    return _chained(cells, keys, (r, False), (r, True))


def opened(cells: DataFrame, keys: list[str], r: int = 1, widened: int = 0) -> DataFrame:
    """The opening by r steps of cells, or of cells dilated by `widened` steps."""
    return _chained(cells, keys, (widened, False), (r, True), (r, False))


def label_cells(cells: DataFrame, stride: int, diagonal: bool = False) -> DataFrame:
    """(cu, cv, label) of one grid's cells under 4- or 8-connection; stride exceeds twice every |cv|.

    A cell's number is cu * stride + cv and a label the smallest number of its component.
    """
    number = F.col("cu") * stride + F.col("cv")
    ids = cells.select(number.cast("long").alias("id")).distinct()
    steps = [1, stride] + ([stride + 1, stride - 1] if diagonal else [])
    edges = ids.select(F.col("id").alias("a"), F.explode(F.array(*[F.col("id") + s for s in steps])).alias("b")).join(ids.withColumnRenamed("id", "b"), "b", "left_semi")
    cv = F.pmod(F.col("id") + stride // 2, F.lit(stride)) - stride // 2
    return components(ids, edges).select(((F.col("id") - cv) / stride).cast("long").alias("cu"), cv.cast("long").alias("cv"), "label")


def grow(labels: DataFrame, allowed: DataFrame, steps: int) -> DataFrame:
    """labels(cu, cv, label) grown into the allowed cells, at most `steps` cells, the largest label first."""
    from .graphs import checkpointed

    for _ in range(steps):
        x = labels.withColumn("s", F.explode(F.array(*[F.struct(F.lit(a).alias("u"), F.lit(b).alias("v")) for a, b in ((0, 1), (1, 0), (0, -1), (-1, 0))])))
        x = x.select((F.col("cu") + F.col("s.u")).alias("cu"), (F.col("cv") + F.col("s.v")).alias("cv"), "label").groupBy("cu", "cv").agg(F.max("label").alias("label"))
        new = checkpointed(x.join(allowed, ["cu", "cv"], "left_semi").join(labels, ["cu", "cv"], "left_anti"))
        if new.isEmpty():
            break
        labels = checkpointed(labels.unionByName(new))
    return labels


def peaks(df: DataFrame, x: Column, step: float, least: float = 0.02) -> DataFrame:
    """(bin, n): local maxima of a 1-D histogram with at least `least` of all counts and 5.

    A maximum is at least as high as both neighbours and higher than one of them; an empty
    neighbour counts 0, one beyond the first or last bin less than that.
    """
    h = df.select(F.floor(x / step).cast("long").alias("bin")).where("bin is not null").groupBy("bin").agg(F.count("*").alias("n"))
    ends = h.agg(F.sum("n").alias("total"), F.min("bin").alias("first"), F.max("bin").alias("last"))
    beside = h.select(F.explode(F.array(F.struct((F.col("bin") + 1).alias("bin"), F.col("n").alias("left"), F.lit(None).cast("long").alias("right")), F.struct((F.col("bin") - 1).alias("bin"), F.lit(None).cast("long").alias("left"), F.col("n").alias("right")))).alias("b")).select("b.*")
    beside = beside.groupBy("bin").agg(F.max("left").alias("left"), F.max("right").alias("right"))
    x = h.join(beside, "bin", "left").crossJoin(F.broadcast(ends))  # one row
    left = F.when(F.col("bin") == F.col("first"), -1).otherwise(F.coalesce("left", F.lit(0)))
    right = F.when(F.col("bin") == F.col("last"), -1).otherwise(F.coalesce("right", F.lit(0)))
    n = F.col("n")
    return x.where((n >= left) & (n >= right) & ((n > left) | (n > right)) & (n >= F.greatest(F.lit(5), F.ceil(F.col("total") * least)))).select("bin", "n")


def plan_grid(points: DataFrame, floor: float, ceiling: float | None = None, path: DataFrame | None = None, resolution: float = 0.04, wall: tuple[float, float] = (0.35, 1.9), band: float = 0.12) -> DataFrame:
    """(cu, cv, occupied, free, u0, v0): points(u, v, h) in the wall band and in the floor band of each plan cell.

    The grid starts half a metre before the least point, at (u0, v0), and ends as much behind the
    last.  A cell that path(u, v) visits counts 3 more as free, once; what lies outside is left out,
    as are points that are not finite.
    """
    finite = lambda df, *names: df.where(" and ".join(f"{c} is not null and not isnan({c}) and abs({c}) < double('infinity')" for c in names))
    points = finite(points, "u", "v", "h")
    box = points.agg(*[(F.min(c) - 0.5).alias(f"{c}0") for c in "uv"], *[(F.max(c) + 0.5).alias(f"{c}1") for c in "uv"])
    top = floor + wall[1] if ceiling is None else min(floor + wall[1], ceiling - 0.15)
    solid = ((F.col("h") > floor + wall[0]) & (F.col("h") < top)).cast("long")
    rows = points.select("u", "v", solid.alias("occupied"), (F.abs(F.col("h") - floor) < band).cast("long").alias("free"), F.lit(False).alias("walked"))
    if path is not None:
        none = F.lit(0).cast("long")
        rows = rows.unionByName(finite(path, "u", "v").select("u", "v", none.alias("occupied"), none.alias("free"), F.lit(True).alias("walked")))
    rows = rows.crossJoin(F.broadcast(box))  # one row
    cell = {c: F.floor((F.col(c) - F.col(f"{c}0")) / resolution).cast("long") for c in "uv"}
    size = {c: F.ceil((F.col(f"{c}1") - F.col(f"{c}0")) / resolution) + 1 for c in "uv"}
    rows = rows.where((cell["u"] >= 0) & (cell["v"] >= 0) & (cell["u"] < size["u"]) & (cell["v"] < size["v"]))
    x = rows.groupBy(cell["u"].alias("cu"), cell["v"].alias("cv"), "u0", "v0").agg(F.sum("occupied").alias("occupied"), (F.sum("free") + F.max(F.col("walked").cast("long")) * 3).alias("free"))
    return x.where("occupied > 0 or free > 0").select("cu", "cv", "occupied", "free", "u0", "v0")


def hidden_spans(cells: DataFrame, key: str, columns: Column, rows: Column, resolution: float, near: int = 3, share: float = 0.3, least: float = 0.25) -> DataFrame:
    """(key, low, high): runs of columns of a surface of which more than `share` is hidden, at least `least` long.

    cells(key, cu, cv, hits, near); a cell is hidden if nothing was seen on it and `near` or more
    points before it.  columns and rows are the size of the surface's grid.
    """
    hidden = F.count_if((F.col("hits") == 0) & (F.col("near") >= near))
    x = cells.groupBy(key, "cu", rows.alias("rows"), columns.alias("columns")).agg(hidden.alias("n"))
    x = x.where((F.col("n") > share * F.col("rows")) & (F.col("cu") >= 0) & (F.col("cu") < F.col("columns")))
    run = F.col("cu") - F.row_number().over(Window.partitionBy(key).orderBy("cu"))
    spans = x.withColumn("run", run).groupBy(key, "run").agg((F.min("cu") * resolution).alias("low"), ((F.max("cu") + 1) * resolution).alias("high"))
    return spans.where(F.col("high") - F.col("low") >= least).select(key, "low", "high")


def fill_holes(cells: DataFrame, by: list[str], size: DataFrame) -> DataFrame:
    """cells(by, cu, cv) with the holes that no path of side neighbours joins to the border of size(by, columns, rows)."""
    from .graphs import checkpointed

    every = size.select(*by, F.explode(F.sequence(F.lit(0), F.col("columns") - 1)).alias("cu"), "columns", "rows").select(*by, "cu", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("cv"), "columns", "rows")
    empty = checkpointed(every.join(cells.select(*by, "cu", "cv"), [*by, "cu", "cv"], "left_anti"))
    # a hole is what no path leads out of
    border = (F.col("cu") == 0) | (F.col("cv") == 0) | (F.col("cu") == F.col("columns") - 1) | (F.col("cv") == F.col("rows") - 1)
    labels = label_groups(empty.select(*by, "cu", "cv"), by, diagonal=False)
    outside = labels.join(empty.where(border).select(*by, "cu", "cv"), [*by, "cu", "cv"], "left_semi").select(*by, "label").distinct()
    return cells.select(*by, "cu", "cv").unionByName(labels.join(outside, [*by, "label"], "left_anti").select(*by, "cu", "cv"))


def label_groups(cells: DataFrame, by: list[str], diagonal: bool) -> DataFrame:
    """(by, cu, cv, label): cells of each grid with the smallest id, as text order has it, of their connected part."""
    from .graphs import components

    name = lambda u, v: F.struct(*by, u.cast("long").alias("cu"), v.cast("long").alias("cv"))
    nodes = cells.select(name(F.col("cu"), F.col("cv")).alias("id")).distinct()
    steps = [(1, 0), (0, 1)] + ([(1, 1), (1, -1)] if diagonal else [])
    step = F.explode(F.array(*[F.struct(F.lit(u).alias("u"), F.lit(v).alias("v")) for u, v in steps]))
    beside = nodes.select("id", step.alias("s")).select(F.col("id").alias("a"), F.struct(*[F.col(f"id.{c}").alias(c) for c in by], (F.col("id.cu") + F.col("s.u")).alias("cu"), (F.col("id.cv") + F.col("s.v")).alias("cv")).alias("b"))
    edges = beside.join(nodes.withColumnRenamed("id", "b"), "b", "left_semi")
    return components(nodes, edges).select("id.*", "label")


def find_openings(cells: DataFrame, by: list[str], size: DataFrame, resolution: float = 0.04, width: float = 0.5, height: float = 0.55, floor: float = 0.16, door: float = 1.6) -> DataFrame:
    """(by, kind, u0, u1, v0, v1, confidence, rim): holes in what was seen of each surface that are large and full enough.

    cells(by, cu, cv, hits, near), size(by, columns, rows).  What was seen, 20 cells or more, is closed
    by a 5x5 block and its holes are filled.  A hole in that is what lies more than a cell from
    anything seen and from cells hidden by two points or more, opened by a 3x3 block.  A part of it is
    an opening if its box is `width` wide and `height` high, is filled to 0.45, and the rim of two
    cells around the part is seen to 0.18.  One that starts within `floor` of the floor is a door if
    `door` high, else a pass-through; others are windows.
    """
    from .graphs import checkpointed
    from .joins import small

    at = [*by, "cu", "cv"]
    size = small(size)
    inside = lambda x: x.join(size, by).where("cu >= 0 and cv >= 0 and cu < columns and cv < rows").drop("columns", "rows")
    seen = inside(cells.where("hits > 0").select(*at))
    seen = checkpointed(seen.join(seen.groupBy(*by).count().where("count >= 20").select(*by), by, "left_semi"))
    shape = checkpointed(fill_holes(checkpointed(erode(inside(dilate(seen, by, 2)), by, 2)), by, size))
    hidden = dilate(inside(cells.where("hits = 0 and near >= 2").select(*at)), by, 1)
    holes = checkpointed(shape.join(dilate(seen, by, 1), at, "left_anti").join(hidden, at, "left_anti"))
    parts = checkpointed(label_groups(checkpointed(opened(holes, by, 1)), by, diagonal=False))
    box = parts.groupBy(*by, "label").agg(F.count("*").alias("n"), F.min("cu").alias("a"), (F.max("cu") + 1).alias("b"), F.min("cv").alias("c"), (F.max("cv") + 1).alias("d"))
    span = lambda x, y: (F.col(y) - F.col(x)) * resolution
    box = box.withColumn("fill", F.col("n") / ((F.col("b") - F.col("a")) * (F.col("d") - F.col("c"))))
    # a width of exactly the least is rounded away by neither side
    box = box.where((span("a", "b") >= width - 1e-9) & (span("c", "d") >= height - 1e-9) & (F.col("fill") >= 0.45))
    rim = inside(dilate(parts, [*by, "label"], 2)).join(parts, [*at, "label"], "left_anti").join(seen.withColumn("hit", F.lit(1.0)), at, "left")
    rim = rim.groupBy(*by, "label").agg(F.avg(F.coalesce("hit", F.lit(0.0))).alias("rim"))
    found = box.join(rim, [*by, "label"]).where("rim >= 0.18")
    low = F.col("c") * resolution <= floor + 1e-9
    kind = F.when(low & (span("c", "d") >= door - 1e-9), "door").when(low, "pass-through").otherwise("window")
    return found.select(*by, kind.alias("kind"), *[(F.col(k) * resolution).alias(n) for k, n in zip("abcd", ("u0", "u1", "v0", "v1"), strict=True)], F.least(F.lit(1.0), "fill").alias("confidence"), "rim")
