"""Queries over points, surfaces and grids, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import binning, geometry
from ..operators import evidence, fits, grids, joins
from ..sources.tables import SQL, points, surface_votes, table
from .series import r6

_G, _P, _V = "WITH " + SQL["votes"], "WITH " + SQL["pts"], "WITH " + SQL["votes"]


def grid_histogram_clip(s, d):
    v = surface_votes(s, d)
    return grids.histogram(v, ["surface"], binning.trunc_clip(F.col("u") - 1, 0.5, 8), binning.trunc_clip(F.col("v"), 0.6, 4))


def grid_histogram_floor(s, d):
    v = surface_votes(s, d)
    return grids.histogram(v, ["surface"], binning.floor_drop(F.col("u") - 1, 0.5, 8), binning.floor_drop(F.col("v"), 0.6, 4))


def grid_hits_near(s, d):
    v = surface_votes(s, d)
    return grids.hits_and_near(v, ["surface"], F.floor(F.col("u") / 0.5).cast("long"), F.floor(F.col("v") / 0.6).cast("long"), F.col("weight") - 0.95, 0.021, 0.041)


def density_image(s, d):
    """Counts of points on a square raster, scaled to 255 at the fullest cell, rounded half to even."""
    p = points(s, d)
    box = p.agg(F.min("x").alias("lx"), F.min("y").alias("ly"), F.greatest(F.max("x") - F.min("x"), F.max("y") - F.min("y")).alias("span"))
    cells = grids.histogram(p.crossJoin(F.broadcast(box)), [], binning.rint_clip(F.col("x"), F.col("lx"), F.col("span"), 32), binning.rint_clip(F.col("y"), F.col("ly"), F.col("span"), 32))
    top = cells.agg(F.max("n").alias("top"))
    return cells.crossJoin(F.broadcast(top)).select("cu", "cv", F.bround(F.col("n") * 255.0 / F.col("top")).cast("long").alias("level"))


def _cells(s, d):
    v = surface_votes(s, d).where("cls = 'R' and weight > 0.97")
    return grids.histogram(v, ["surface"], F.floor(F.col("u") / 0.25), F.floor(F.col("v") / 0.25)).select("surface", "cu", "cv")


def grid_dilate(s, d):
    return grids.dilate(_cells(s, d), ["surface"])


def grid_close(s, d):
    return grids.close(_cells(s, d), ["surface"])


def grid_open(s, d):
    return grids.opened(_cells(s, d), ["surface"], widened=1)


def _plan(s, d):
    p = points(s, d)
    return grids.histogram(p, [], F.floor(F.col("x") / 0.05), F.floor(F.col("y") / 0.05)).where("cu is not null and cv is not null").select("cu", "cv")


def grid_components(s, d):
    return grids.label_cells(_plan(s, d), 1_000_000_000, diagonal=True)


def grid_grow(s, d):
    """Labels grown two cells into the dilated plan."""
    cells = _plan(s, d)
    return grids.grow(grids.label_cells(cells, 1_000_000_000, diagonal=True), grids.dilate(cells, [], 2), 2)


def vote_grid(s, d):
    v = surface_votes(s, d).withColumn("cu", F.floor(F.col("u") / 0.5)).withColumn("cv", F.floor(F.col("v") / 0.6))
    out = evidence.votes(v, ["surface", "cu", "cv"], F.col("weight"), F.col("v") / 3, "cls")
    return out.select("surface", "cu", "cv", "cls", "views", *r6("weight", "score"))


def region_support(s, d):
    v = surface_votes(s, d).withColumn("cu", F.floor(F.col("u") / 0.5))
    return evidence.supported(v, ["surface", "cu"], F.col("weight"), "frame", 60, 50.0).select("surface", "cu", "views", *r6("weight"))


def region_support_frames(s, d):
    v = surface_votes(s, d).withColumn("cu", F.floor(F.col("u") / 0.5))
    return evidence.supported(v, ["surface", "cu"], F.col("weight"), "frame", 60, 50.0, True).select("surface", "cu", "views", *r6("weight"))


def dominant_class(s, d):
    return evidence.dominant_class(surface_votes(s, d), "surface", "cls", F.when(F.col("cls") == "N", F.col("weight") * 0.6).otherwise(F.col("weight")), none=None)


def weighted_mode(s, d):
    v = surface_votes(s, d).withColumn("kind", F.when(F.col("u") > 1, F.floor("u").cast("long")))
    return evidence.weighted_mode(v, "surface", "kind", F.round(F.col("weight") * 100).cast("long"), "frame")


def histogram_peaks(s, d):
    return grids.peaks(table(s, d, "orders"), F.col("o_totalprice"), 5000.0, 0.005)


def quantile_trend(s, d):
    return evidence.quantile_trend(table(s, d, "lineitem"), "l_extendedprice", "l_quantity", 12, 200).select("bin", *r6("x", "y"), "n")


def linear_trend(s, d):
    return table(s, d, "lineitem").groupBy("l_returnflag").agg(F.round(F.regr_slope("l_extendedprice", "l_quantity"), 4).alias("slope"), F.round(F.regr_intercept("l_extendedprice", "l_quantity"), 3).alias("intercept"))


def circular_mean(s, d):
    return evidence.circular_frame(points(s, d), "label", F.col("nx"), F.col("ny")).select("label", *r6("yaw", "manhattan"))


def tls_line(s, d):
    return fits.tls_lines(points(s, d), "label", "x", "y").select("label", "n", *r6("angle", "offset", "rms"))


def ransac_score(s, d):
    """Inliers of 36 fixed lines per label, the best of each; of equals the smaller angle."""
    h = s.range(36).select(F.col("id").alias("line"), (F.col("id") * 0.08726646259971647).alias("angle"))
    return fits.best_line(points(s, d), "label", "x", "y", h, 0.05).select("label", "line", "inliers")


def ransac_pairs(s, d):
    """The best of 300 lines through two points of each label, with its angle, offset and inliers."""
    return fits.best_pair_line(points(s, d), "label", "id", "x", "y", 0.05).select("label", "line", *r6("angle", "offset"), "inliers")


def loop_candidates(s, d):
    x = joins.loop_candidates(points(s, d), "id", ["x", "y", "z"], ["nx", "ny", "nz"], 0.3, 4, geometry.DEGREES_70, 220)
    return x.select("i", "j", *r6("distance"))


def endpoint_gaps(s, d):
    """How far each point is from the nearest other one within 0.5, as quantiles."""
    x = joins.nearest_other(points(s, d), "id", ["x", "y", "z"], 0.5).withColumnRenamed("distance", "d")
    return x.agg(F.count("*").alias("n"), F.round(F.median("d"), 6).alias("p50"), F.round(F.percentile("d", 0.9), 6).alias("p90"), F.round(F.max("d"), 6).alias("largest"))


def endpoint_components(s, d):
    return joins.near_components(points(s, d), "id", ["x", "y", "z"], 0.12)


def nearest_surface(s, d):
    """Each point with the nearest of ten centroids within 0.3."""
    p = points(s, d)
    c = p.groupBy("label").agg(F.avg("x").alias("mx"), F.avg("y").alias("my"), F.avg("z").alias("mz")).withColumnRenamed("label", "surface")
    return joins.nearest_place(p, "id", c, "surface", ["x", "y", "z"], ["mx", "my", "mz"], 0.3).select("id", "surface", *r6("distance"))


def best_wall_match(s, d):
    """Each part with the supplier whose balance is nearest to ten times its price, within 200."""
    p = table(s, d, "part").select("p_partkey", F.col("p_retailprice").alias("price"))
    w = table(s, d, "supplier").select("s_suppkey", "s_acctbal")
    return joins.nearest_within(p, "p_partkey", (F.col("price") - 900) * 10, w, "s_suppkey", F.col("s_acctbal"), 200.0)


def opposing_pairs(s, d):
    p = table(s, d, "part").select("p_partkey", "p_brand", F.col("p_size").cast("double").alias("o"), (F.pmod("p_partkey", F.lit(10)) * 0.5).cast("double").alias("lo"), (F.pmod("p_partkey", F.lit(10)) * 0.5 + 1 + F.pmod("p_partkey", F.lit(3))).cast("double").alias("hi"))
    return joins.opposing(p, "p_partkey", "p_brand", "o", ("lo", "hi"), 1.0, 3.0, 0.25)


def ray_block_filter(s, d):
    """The older name of ray_block_all, from when only some points blocked."""
    return ray_block_all(s, d)


def ray_block_all(s, d):
    """The same where every point of another label blocks."""
    return joins.blocked_near(points(s, d), "label", ("x", "y"), 0.05, "id", 0.33, 20).select("label", "n", *r6("blocked"))


def interval_overlap_pairs(s, d):
    """Orders of one customer whose price intervals overlap by 15% or more."""
    o = table(s, d, "orders").select("o_custkey", "o_orderkey", F.col("o_totalprice").alias("a"), (F.col("o_totalprice") * 1.3).alias("b"))
    x, y = (o.select("o_custkey", *[F.col(c).alias(f"{c}{k}") for c in ("o_orderkey", "a", "b")]) for k in (1, 2))
    iou = geometry.overlap((F.col("a1"), F.col("b1")), (F.col("a2"), F.col("b2")))
    return x.join(y, "o_custkey").where("o_orderkey1 < o_orderkey2").select("o_orderkey1", "o_orderkey2", iou.alias("iou")).where("iou >= 0.15").select("o_orderkey1", "o_orderkey2", *r6("iou"))


def hint_antijoin(s, d):
    """Open orders that no finished order of the customer overlaps by 15%."""
    o = table(s, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("a"), (F.col("o_totalprice") * 1.3).alias("b"))
    f = o.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c"), F.col("a").alias("fa"), F.col("b").alias("fb"))
    near = (F.col("o_custkey") == F.col("c")) & (geometry.overlap((F.col("a"), F.col("b")), (F.col("fa"), F.col("fb"))) >= 0.15)
    return o.where("o_orderstatus = 'O'").join(f, near, "left_anti").select("o_orderkey")


def greedy_fusion(s, d):
    from ..operators import folds

    o = table(s, d, "orders").select("o_custkey", "o_orderkey", (F.col("o_totalprice") / 1e5).alias("lo"), (F.col("o_totalprice") / 1e5 + 0.4).alias("hi"), (F.pmod("o_orderkey", F.lit(9)) / 10.0).alias("c"))
    return folds.fuse_intervals(o, "o_custkey", "lo", "hi", "c", "o_orderkey").select("o_custkey", "head", "n", *r6("low", "high", "confidence"))


def voxel_downsample(s, d):
    """Mean position per cube of 0.2."""
    p = points(s, d)
    cube = [F.floor(F.col(c) / 0.2).alias(f"c{c}") for c in "xyz"]
    return p.groupBy(*cube).agg(F.count("*").alias("n"), *[F.round(F.avg(c), 6).alias(c) for c in "xyz"])


def rotation_angle(s, d):
    """Degrees between the rotation of each point's four numbers and no rotation."""
    m = geometry.quaternion_matrix(F.col("x"), F.col("y"), F.col("z"), F.col("nx"))
    eye = F.array(*[F.lit(float(i % 4 == 0)) for i in range(9)])
    return points(s, d).select("id", F.round(geometry.rotation_degrees(m, eye), 4).alias("degrees"))


def normal_classes(s, d):
    """Compass name, canonical sign and distance from the axes of each normal."""
    x, y = F.col("nx"), F.col("ny")
    return points(s, d).select("id", geometry.compass(x, y).alias("compass"), geometry.canonical_sign(x, y).alias("sign"), F.round(geometry.manhattan_deviation(x, y), 6).alias("deviation"))


def polygon_area(s, d):
    """Area of each label's bounding quadrilateral and whether its mean point lies inside."""
    g = points(s, d).groupBy("label").agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"), F.avg("x").alias("mx"), F.avg("y").alias("my"))
    at = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    poly = F.array(at("x0", "y0"), at("x1", "y0"), at("x1", "y1"), at("x0", "y1"))
    return g.select("label", F.round(geometry.signed_area(poly), 6).alias("area"), geometry.point_in_polygon(F.col("mx"), F.col("my"), poly).alias("inside"))


_CELLS = f"{_V}, cells AS (SELECT DISTINCT surface, floor(u / 0.25)::BIGINT AS cu, floor(v / 0.25)::BIGINT AS cv FROM votes WHERE cls = 'R' AND weight > 0.97), o AS (SELECT unnest([-1, 0, 1]) AS i), oo AS (SELECT a.i AS du, b.i AS dv FROM o a, o b), di AS (SELECT DISTINCT surface, cu + du AS cu, cv + dv AS cv FROM cells, oo)"
_ER = "(SELECT surface, cu + du AS cu, cv + dv AS cv FROM {t}, oo GROUP BY ALL HAVING count(*) = 9)"
_PLAN = f"WITH RECURSIVE {SQL['pts']}, plan AS (SELECT DISTINCT floor(x / 0.05)::BIGINT AS cu, floor(y / 0.05)::BIGINT AS cv FROM pts WHERE x IS NOT NULL AND y IS NOT NULL), reach AS (SELECT cu * 1000000000 + cv AS root, cu, cv FROM plan UNION SELECT r.root, p.cu, p.cv FROM reach r JOIN plan p ON abs(p.cu - r.cu) <= 1 AND abs(p.cv - r.cv) <= 1), lab AS (SELECT cu, cv, min(root) AS label FROM reach GROUP BY cu, cv)"
_NP = "pr AS (SELECT a.id AS i, b.id AS j, sqrt((a.x-b.x)**2 + (a.y-b.y)**2 + (a.z-b.z)**2) AS distance, (a.nx*b.nx + a.ny*b.ny + a.nz*b.nz) / sqrt(a.nx**2 + a.ny**2 + a.nz**2) / sqrt(b.nx**2 + b.ny**2 + b.nz**2) AS c FROM pts a JOIN pts b ON a.id < b.id)"

QUERIES = {
    f.__name__: f
    for f in (grid_histogram_clip, grid_histogram_floor, grid_hits_near, density_image, grid_dilate, grid_close, grid_open, grid_components, grid_grow, vote_grid, region_support, region_support_frames, dominant_class, weighted_mode, histogram_peaks, quantile_trend, linear_trend, circular_mean, tls_line, ransac_score, ransac_pairs, loop_candidates, endpoint_gaps, endpoint_components, nearest_surface, best_wall_match, opposing_pairs, ray_block_filter, ray_block_all, interval_overlap_pairs, hint_antijoin, greedy_fusion, voxel_downsample, rotation_angle, normal_classes, polygon_area)
}

ORACLES = {
    "ray_block_all": f"{_P}, h AS (SELECT a.label, a.id, EXISTS (SELECT 1 FROM pts b WHERE b.label <> a.label AND abs(a.x - b.x) < 0.05 AND abs(a.y - b.y) < 0.05) AS hit FROM pts a) SELECT label, count(*) AS n, round(avg(hit::INT), 6) AS blocked FROM h GROUP BY label HAVING count(*) >= 20 AND avg(hit::INT) >= 0.33",
    "grid_histogram_clip": f"{_V} SELECT surface, least(greatest(trunc((u - 1) / 0.5)::BIGINT, 0), 7) AS cu, least(greatest(trunc(v / 0.6)::BIGINT, 0), 3) AS cv, count(*) AS n FROM votes GROUP BY ALL",
    "grid_histogram_floor": f"{_V}, c AS (SELECT surface, floor((u - 1) / 0.5)::BIGINT AS cu, floor(v / 0.6)::BIGINT AS cv FROM votes) SELECT surface, cu, cv, count(*) AS n FROM c WHERE cu BETWEEN 0 AND 7 AND cv BETWEEN 0 AND 3 GROUP BY ALL",
    "grid_hits_near": f"{_V}, c AS (SELECT surface, floor(u / 0.5)::BIGINT AS cu, floor(v / 0.6)::BIGINT AS cv, abs(weight - 0.95) AS d FROM votes) SELECT surface, cu, cv, count(*) FILTER (d < 0.021) AS hits, count(*) FILTER (d >= 0.021 AND d < 0.041) AS near FROM c GROUP BY ALL HAVING count(*) FILTER (d < 0.041) > 0",
    "density_image": f"{_P}, b AS (SELECT min(x) AS lx, min(y) AS ly, greatest(max(x) - min(x), max(y) - min(y)) AS span FROM pts), c AS (SELECT least(greatest(round_even((x - lx) / span * 32, 0)::BIGINT, 0), 31) AS cu, least(greatest(round_even((y - ly) / span * 32, 0)::BIGINT, 0), 31) AS cv, count(*) AS n FROM pts, b GROUP BY ALL) SELECT cu, cv, round_even(n * 255.0::DOUBLE / max(n) OVER (), 0)::BIGINT AS level FROM c",
    "grid_dilate": f"{_CELLS} SELECT * FROM di",
    "grid_close": f"{_CELLS} SELECT * FROM {_ER.format(t='di')}",
    "grid_open": f"{_CELLS}, er AS {_ER.format(t='di')} SELECT DISTINCT surface, cu + du AS cu, cv + dv AS cv FROM er, oo",
    "grid_components": f"{_PLAN} SELECT cu, cv, label FROM lab",
    "grid_grow": f"{_PLAN}, o2 AS (SELECT unnest([-2, -1, 0, 1, 2]) AS i), al AS (SELECT DISTINCT cu + a.i AS cu, cv + b.i AS cv FROM plan, o2 a, o2 b), st AS (SELECT * FROM (VALUES (0, 1), (1, 0), (0, -1), (-1, 0)) t(u, v)), g1 AS (SELECT cu, cv, label FROM lab UNION ALL SELECT n.cu, n.cv, max(n.label) FROM (SELECT cu + u AS cu, cv + v AS cv, label FROM lab, st) n JOIN al ON n.cu = al.cu AND n.cv = al.cv WHERE (n.cu, n.cv) NOT IN (SELECT (cu, cv) FROM lab) GROUP BY n.cu, n.cv) SELECT cu, cv, label FROM g1 UNION ALL SELECT n.cu, n.cv, max(n.label) FROM (SELECT cu + u AS cu, cv + v AS cv, label FROM g1, st) n JOIN al ON n.cu = al.cu AND n.cv = al.cv WHERE (n.cu, n.cv) NOT IN (SELECT (cu, cv) FROM g1) GROUP BY n.cu, n.cv",
    "vote_grid": f"{_V} SELECT surface, floor(u / 0.5)::BIGINT AS cu, floor(v / 0.6)::BIGINT AS cv, cls, count(*) AS views, round(sum(weight), 6) AS weight, round(sum(weight * (v / 3)), 6) AS score FROM votes GROUP BY ALL",
    "region_support": f"{_V} SELECT surface, floor(u / 0.5)::BIGINT AS cu, count(*) AS views, round(sum(weight), 6) AS weight FROM votes GROUP BY ALL HAVING count(*) >= 60 AND sum(weight) >= 50",
    "region_support_frames": f"{_V} SELECT surface, floor(u / 0.5)::BIGINT AS cu, count(DISTINCT frame) AS views, round(sum(weight), 6) AS weight FROM votes GROUP BY ALL HAVING count(DISTINCT frame) >= 60 AND sum(weight) >= 50",
    "dominant_class": f"{_V}, t AS (SELECT surface, cls, sum(CASE WHEN cls = 'N' THEN weight * 0.6::DOUBLE ELSE weight END) AS w FROM votes GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY surface ORDER BY w DESC, cls) AS k FROM t), p AS (SELECT surface, max(cls) FILTER (k = 1) AS top, max(cls) FILTER (k = 2) AS second, max(w) FILTER (k = 1) AS w1, max(w) FILTER (k = 2) AS w2 FROM r GROUP BY surface) SELECT surface, top, second, CASE WHEN coalesce(w2 >= 0.4::DOUBLE * w1, false) THEN 'combined' ELSE top END AS dominant FROM p",
    "weighted_mode": f"{_V}, t AS (SELECT surface, floor(u)::BIGINT AS kind, sum(round(weight * 100)::BIGINT) AS w, min(frame) AS o FROM votes WHERE u > 1 GROUP BY ALL) SELECT surface, kind AS mode FROM (SELECT *, row_number() OVER (PARTITION BY surface ORDER BY w DESC, o) AS k FROM t) WHERE k = 1",
    "histogram_peaks": "WITH h AS (SELECT floor(o_totalprice / 5000)::BIGINT AS bin, count(*) AS n FROM orders GROUP BY 1) SELECT a.bin, a.n FROM h a LEFT JOIN h l ON l.bin = a.bin - 1 LEFT JOIN h r ON r.bin = a.bin + 1 LEFT JOIN (SELECT min(bin) AS lo, max(bin) AS hi FROM h) e ON true WHERE a.n >= CASE WHEN a.bin = lo THEN -1 ELSE coalesce(l.n, 0) END AND a.n >= CASE WHEN a.bin = hi THEN -1 ELSE coalesce(r.n, 0) END AND (a.n > CASE WHEN a.bin = lo THEN -1 ELSE coalesce(l.n, 0) END OR a.n > CASE WHEN a.bin = hi THEN -1 ELSE coalesce(r.n, 0) END) AND a.n >= greatest(5, ceil((SELECT sum(n) FROM h) * 0.005))",
    "quantile_trend": "WITH e AS (SELECT list_distinct([quantile_cont(l_extendedprice, 0 / 12.0::DOUBLE), quantile_cont(l_extendedprice, 1 / 12.0::DOUBLE), quantile_cont(l_extendedprice, 2 / 12.0::DOUBLE), quantile_cont(l_extendedprice, 3 / 12.0::DOUBLE), quantile_cont(l_extendedprice, 4 / 12.0::DOUBLE), quantile_cont(l_extendedprice, 5 / 12.0::DOUBLE), quantile_cont(l_extendedprice, 6 / 12.0::DOUBLE), quantile_cont(l_extendedprice, 7 / 12.0::DOUBLE), quantile_cont(l_extendedprice, 8 / 12.0::DOUBLE), quantile_cont(l_extendedprice, 9 / 12.0::DOUBLE), quantile_cont(l_extendedprice, 10 / 12.0::DOUBLE), quantile_cont(l_extendedprice, 11 / 12.0::DOUBLE), quantile_cont(l_extendedprice, 1.0)]) AS e FROM lineitem), z AS (SELECT l_extendedprice AS x, l_quantity AS y, len(list_filter(e, lambda v: v <= l_extendedprice)) AS bin, len(e) AS k FROM lineitem, e) SELECT bin, round(median(x), 6) AS x, round(median(y), 6) AS y, count(*) AS n FROM z WHERE bin < k GROUP BY bin HAVING count(*) >= 200",
    "linear_trend": "SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept FROM lineitem GROUP BY 1",
    "circular_mean": f"{_P}, m AS (SELECT label, avg(cos(4 * atan2(ny, nx))) AS c, avg(sin(4 * atan2(ny, nx))) AS s FROM pts GROUP BY label) SELECT label, round(atan2(s, c) / 4, 6) AS yaw, round(sqrt(c * c + s * s), 6) AS manhattan FROM m",
    "tls_line": f"{_P}, m AS (SELECT label, count(*) AS n, avg(x) AS mx, avg(y) AS my, covar_pop(x, y) AS sxy, var_pop(x) AS sxx, var_pop(y) AS syy FROM pts GROUP BY label), a AS (SELECT *, atan2(2 * sxy, sxx - syy) / 2 AS ang FROM m) SELECT label, n, round(ang, 6) AS angle, round(-sin(ang) * mx + cos(ang) * my, 6) AS \"offset\", round(sqrt(greatest(0, sin(ang)**2 * sxx - 2 * sin(ang) * cos(ang) * sxy + cos(ang)**2 * syy)), 6) AS rms FROM a",
    "ransac_score": f"{_P}, h AS (SELECT range AS line, range * 0.08726646259971647::DOUBLE AS ang FROM range(36)), c AS (SELECT label, avg(x) AS mx, avg(y) AS my FROM pts GROUP BY label), s AS (SELECT pts.label, line, count(*) FILTER (abs(-sin(ang) * (x - mx) + cos(ang) * (y - my)) <= 0.05) AS inliers FROM pts JOIN c ON pts.label = c.label, h GROUP BY ALL) SELECT label, line, inliers FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY inliers DESC, line) AS k FROM s) WHERE k = 1",
    "loop_candidates": f"{_P}, {_NP} SELECT i, j, round(distance, 6) AS distance FROM pr WHERE distance < 0.3 AND j - i > 4 AND c >= cos(radians(70)) ORDER BY pr.distance, i, j LIMIT 220",
    "endpoint_gaps": f"{_P}, {_NP}, b AS (SELECT i, distance FROM pr WHERE distance < 0.5 UNION ALL SELECT j, distance FROM pr WHERE distance < 0.5), m AS (SELECT i, min(distance) AS d FROM b GROUP BY i) SELECT count(*) AS n, round(median(d), 6) AS p50, round(quantile_cont(d, 0.9), 6) AS p90, round(max(d), 6) AS largest FROM m",
    "endpoint_components": f"WITH RECURSIVE {SQL['pts']}, {_NP}, e AS (SELECT i AS a, j AS b FROM pr WHERE distance < 0.12 UNION SELECT j, i FROM pr WHERE distance < 0.12), r AS (SELECT id AS root, id FROM pts UNION SELECT r.root, e.b FROM r JOIN e ON e.a = r.id) SELECT id, min(root) AS label FROM r GROUP BY id",
    "nearest_surface": f"{_P}, c AS (SELECT label AS surface, avg(x) AS mx, avg(y) AS my, avg(z) AS mz FROM pts GROUP BY label), n AS (SELECT id, surface, sqrt((x-mx)**2 + (y-my)**2 + (z-mz)**2) AS distance FROM pts, c), k AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, surface) AS k FROM n WHERE distance < 0.3) SELECT id, surface, round(distance, 6) AS distance FROM k WHERE k = 1",
    "best_wall_match": "SELECT p_partkey, s_suppkey FROM (SELECT p_partkey, s_suppkey, row_number() OVER (PARTITION BY p_partkey ORDER BY abs(s_acctbal - (p_retailprice - 900) * 10), s_suppkey) AS k FROM part, supplier WHERE abs(s_acctbal - (p_retailprice - 900) * 10) <= 200) WHERE k = 1",
    "opposing_pairs": "WITH p AS (SELECT p_partkey AS i, p_brand AS g, p_size::DOUBLE AS o, (p_partkey % 10) * 0.5::DOUBLE AS lo, (p_partkey % 10) * 0.5::DOUBLE + 1 + p_partkey % 3 AS hi FROM part), x AS (SELECT a.i, b.i AS j, abs(a.o - b.o) AS s FROM p a JOIN p b ON a.g = b.g AND a.i <> b.i WHERE abs(a.o - b.o) BETWEEN 1 AND 3 AND least(a.hi, b.hi) - greatest(a.lo, b.lo) >= greatest(0.25, 0.25 * least(a.hi - a.lo, b.hi - b.lo))) SELECT i AS p_partkey, j AS other, s AS separation FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY s, j) AS k FROM x) WHERE k = 1",
    "interval_overlap_pairs": "WITH o AS (SELECT o_custkey, o_orderkey AS k, o_totalprice AS a, o_totalprice * 1.3::DOUBLE AS b FROM orders), x AS (SELECT p.k AS o_orderkey1, q.k AS o_orderkey2, greatest(0, least(p.b, q.b) - greatest(p.a, q.a)) / (greatest(p.b, q.b) - least(p.a, q.a)) AS iou FROM o p JOIN o q ON p.o_custkey = q.o_custkey AND p.k < q.k) SELECT o_orderkey1, o_orderkey2, round(iou, 6) AS iou FROM x WHERE iou >= 0.15",
    "hint_antijoin": "WITH o AS (SELECT *, o_totalprice AS a, o_totalprice * 1.3::DOUBLE AS b FROM orders) SELECT o_orderkey FROM o p WHERE o_orderstatus = 'O' AND NOT EXISTS (SELECT 1 FROM o q WHERE q.o_orderstatus = 'F' AND q.o_custkey = p.o_custkey AND greatest(0, least(p.b, q.b) - greatest(p.a, q.a)) / (greatest(p.b, q.b) - least(p.a, q.a)) >= 0.15)",
    "voxel_downsample": f"{_P} SELECT floor(x / 0.2)::BIGINT AS cx, floor(y / 0.2)::BIGINT AS cy, floor(z / 0.2)::BIGINT AS cz, count(*) AS n, round(avg(x), 6) AS x, round(avg(y), 6) AS y, round(avg(z), 6) AS z FROM pts GROUP BY 1, 2, 3",
    "rotation_angle": f"{_P}, q AS (SELECT id, nx / sqrt(x*x + y*y + z*z + nx*nx) AS w FROM pts) SELECT id, round(degrees(acos(greatest(-1, least(1, (3 - 4 * (1 - w*w) - 1) / 2)))), 4) AS degrees FROM q",
    "normal_classes": f"{_P} SELECT id, ['north','northeast','east','southeast','south','southwest','west','northwest'][(floor(((degrees(atan2(nx, ny)) + 360) % 360 + 22.5) / 45)::BIGINT % 8 + 1)::INT] AS compass, CASE WHEN nx < -1e-9 OR (abs(nx) <= 1e-9 AND ny < 0) THEN -1.0 ELSE 1.0 END::DOUBLE AS sign, round(abs(degrees(atan2(ny, nx)) - round_even(degrees(atan2(ny, nx)) / 90, 0) * 90), 6) AS deviation FROM pts",
    "polygon_area": f"{_P} SELECT label, round((max(x) - min(x)) * (max(y) - min(y)), 6) AS area, avg(x) BETWEEN min(x) AND max(x) AND avg(y) BETWEEN min(y) AND max(y) AS inside FROM pts GROUP BY label",
}
ORACLES["ray_block_filter"] = ORACLES["ray_block_all"]
