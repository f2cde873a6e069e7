"""Queries of wall graphs, their faces and outlines of cells, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rings, segments
from ..sources.tables import table
from .series import r6
from .space import _PLAN, _plan

_e = lambda i: F.col("embedding")[i].cast("double")


def plan_walls(s, d):
    """(scene, wall, x0, y0, x1, y1): forty walls a scene, level, upright and some slanted, in quarters of a metre."""
    x = table(s, d, "embeddings").select(F.expr("vec_id div 40").alias("scene"), F.col("vec_id").alias("wall"), (F.floor(_e(0) * 80) / 4).alias("x0"), (F.floor(_e(1) * 80) / 4).alias("y0"), (4 + F.floor(F.abs(_e(2)) * 80) / 4).alias("l"))
    kind = F.pmod("wall", F.lit(8))
    across = F.when(kind == 7, 1.0).otherwise(F.when(kind % 2 == 0, 1.0).otherwise(0.0))
    up = F.when(kind == 7, 0.75).otherwise(F.when(kind % 2 == 0, 0.0).otherwise(1.0))
    return x.select("scene", "wall", "x0", "y0", (F.col("x0") + F.col("l") * across).alias("x1"), (F.col("y0") + F.col("l") * up).alias("y1"))


def wall_stops(s, d):
    """How many stops each wall has, and how far along they are."""
    x = rings.wall_stops(plan_walls(s, d), "scene")
    return x.groupBy("scene", "wall").agg(F.count("*").alias("n"), F.round(F.sum("t"), 6).alias("t"))


def wall_faces(s, d):
    """The bounded faces of each scene's walls, accepted ones numbered."""
    x = rings.wall_faces(plan_walls(s, d), "scene")
    # areas in 512ths would tie at the sixth place
    return x.select("scene", "face", F.round(F.col("area") + 1e-9, 6).alias("area"), *r6("cx", "cy"), F.size("polygon").alias("corners"), F.size("holes").alias("holes"), "reason")


def outline_rings(s, d):
    """The outlines of each connected part of the plan's cells."""
    from ..operators.grids import label_cells

    x = rings.outline_rings(label_cells(_plan(s, d), 1_000_000_000, diagonal=True), ["label"])
    return x.select("label", F.col("ring.x").alias("x"), F.col("ring.y").alias("y"), F.col("ring.d").alias("d"), "n", F.round("area", 6).alias("area"), F.round(F.aggregate("points", F.lit(0.0), lambda a, p: a + p["x"] * 3 + p["y"]), 6).alias("middles"))


def rectified_polygons(s, d):
    """Six points of each row, rectified: its corners, area and first corner."""
    from ..functions.geometry import signed_area

    at = lambda i, x, y: F.struct((x + _e(2 * i) * 2).alias("x"), (y + _e(2 * i + 1) * 2).alias("y"))
    ring = ((0, 0), (2, 0), (4, 0), (4, 3), (1, 3), (0, 2))
    x = table(s, d, "embeddings").select("vec_id", rings.rectified(F.array(*[at(i, F.lit(float(a)), F.lit(float(b))) for i, (a, b) in enumerate(ring)])).alias("p"))
    return x.select("vec_id", F.size("p").alias("corners"), F.round(signed_area(F.col("p")), 6).alias("area"), F.round(F.col("p")[0]["x"], 6).alias("x"), F.round(F.col("p")[0]["y"], 6).alias("y"))


def _floor_cells(s, d):
    """(scene, cu, cv, occupied, free): cells of a quarter of a metre that floor was seen in, some of them with walls."""
    x = table(s, d, "embeddings").select(F.expr("vec_id div 40").alias("scene"), F.floor(_e(4) * 80).alias("cu"), F.floor(_e(5) * 80).alias("cv"), F.pmod("vec_id", F.lit(8)).alias("occupied"), F.pmod("vec_id", F.lit(5)).alias("free"))
    return x.groupBy("scene", "cu", "cv").agg(F.sum("occupied").alias("occupied"), F.sum("free").alias("free"))


def room_segments(s, d):
    """The rooms of each scene, with how many walls bound them and how many rooms share one."""
    x, _ = segments.segmented_rooms(_floor_cells(s, d), plan_walls(s, d), "scene", 0.25)
    return x.select("scene", "room", "name", "source", F.round(F.col("area") + 1e-9, 6).alias("area"), *r6("cx", "cy"), F.coalesce(F.size("walls"), F.lit(0)).alias("walls"), F.coalesce(F.size("neighbours"), F.lit(0)).alias("neighbours"))


def room_scenes(s, d):
    """Which scenes have rooms, or why not, where half of the walls are missing."""
    walls = plan_walls(s, d).where("wall % 8 < 3 or scene % 3 > 0")
    _, scenes = segments.segmented_rooms(_floor_cells(s, d), walls, "scene", 0.25)
    return scenes


def rasterised_walls(s, d):
    """Cells of the walls of each scene on a grid of half metres."""
    w = plan_walls(s, d)
    size = w.select("scene").distinct().select("scene", F.lit(-8.0).alias("u0"), F.lit(-8.0).alias("v0"), F.lit(32).alias("columns"), F.lit(32).alias("rows"))
    return segments.rasterised_walls(w, "scene", 0.5, size)


def probed_walls(s, d):
    """The rooms, here squares of two metres, that lie beside each wall."""
    w = plan_walls(s, d)
    labels = w.select("scene").distinct().select("scene", F.explode(F.sequence(F.lit(-40), F.lit(39))).alias("cu")).select("scene", "cu", F.explode(F.sequence(F.lit(-40), F.lit(39))).alias("cv")).select("scene", F.col("cu").cast("long").alias("cu"), F.col("cv").cast("long").alias("cv"), (F.floor(F.col("cu") / 4) * 100 + F.floor(F.col("cv") / 4)).alias("room"))
    return segments.probed_walls(w, labels, "scene", 0.5)


_WALLS = """e AS (SELECT vec_id // 40 AS scene, vec_id AS wall, vec_id % 8 AS k, floor(embedding[1]::DOUBLE * 80) / 4 AS x0, floor(embedding[2]::DOUBLE * 80) / 4 AS y0, 4 + floor(abs(embedding[3]::DOUBLE) * 80) / 4 AS l FROM embeddings),
walls AS (SELECT scene, wall, x0, y0, x0 + l * CASE WHEN k = 7 OR k % 2 = 0 THEN 1.0::DOUBLE ELSE 0 END AS x1, y0 + l * CASE WHEN k = 7 THEN 0.75::DOUBLE WHEN k % 2 = 0 THEN 0 ELSE 1 END AS y1 FROM e)"""

_STOPS = f"""{_WALLS},
w AS (SELECT *, sqrt((x1 - x0)**2 + (y1 - y0)**2) AS len, (x1 - x0) / sqrt((x1 - x0)**2 + (y1 - y0)**2) AS dx, (y1 - y0) / sqrt((x1 - x0)**2 + (y1 - y0)**2) AS dy FROM walls),
pr AS (SELECT a.scene, a.wall, a.x0, a.y0, a.dx, a.dy, a.len, b.x0 AS bx0, b.y0 AS by0, b.x1 AS bx1, b.y1 AS by1, b.dx AS bdx, b.dy AS bdy, b.len AS blen, a.dx * b.dy - a.dy * b.dx AS det FROM w a JOIN w b ON a.scene = b.scene AND a.wall <> b.wall),
cr AS (SELECT *, x0 + dx * t AS mx, y0 + dy * t AS my FROM (SELECT *, ((bx0 - x0) * bdy - (by0 - y0) * bdx) / det AS t FROM pr WHERE abs(det) >= 1e-9)),
en AS (SELECT scene, wall, x0, y0, dx, dy, len, bx0 AS px, by0 AS py FROM pr UNION ALL SELECT scene, wall, x0, y0, dx, dy, len, bx1, by1 FROM pr),
eo AS (SELECT *, (px - x0) * dx + (py - y0) * dy AS t, abs((px - x0) * dy - (py - y0) * dx) AS away FROM en),
st AS (SELECT scene, wall, 0.0::DOUBLE AS t, x0 AS x, y0 AS y FROM w UNION ALL SELECT scene, wall, len, x1, y1 FROM w
 UNION ALL SELECT scene, wall, t, mx, my FROM cr WHERE t BETWEEN -1e-9 AND len + 1e-9 AND (mx - bx0) * bdx + (my - by0) * bdy BETWEEN -1e-9 AND blen + 1e-9
 UNION ALL SELECT scene, wall, t, px, py FROM eo WHERE t >= 0 AND t <= len AND away < 0.08),
stops AS MATERIALIZED (SELECT DISTINCT scene, wall, t, round(x, 9) AS x, round(y, 9) AS y FROM st)"""

_GRAPH = f"""{_STOPS},
nd AS MATERIALIZED (SELECT scene, x, y, dense_rank() OVER (ORDER BY scene, x, y) AS id FROM (SELECT DISTINCT scene, x, y FROM stops WHERE scene IN (SELECT scene FROM walls GROUP BY scene HAVING count(*) >= 3))),
nr AS MATERIALIZED (SELECT a.id AS a, b.id AS b FROM nd a JOIN nd b ON a.scene = b.scene AND a.id <> b.id AND sqrt((a.x - b.x)**2 + (a.y - b.y)**2) < 0.08),
rc AS (SELECT a AS root, a AS id FROM nr UNION SELECT rc.root, nr.b FROM rc JOIN nr ON nr.a = rc.id),
mg AS (SELECT id, min(root) AS rep FROM rc GROUP BY id),
so AS (SELECT stops.scene, wall, t, coalesce(rep, nd.id) AS n FROM stops JOIN nd ON nd.scene = stops.scene AND nd.x = stops.x AND nd.y = stops.y LEFT JOIN mg ON mg.id = nd.id),
sq AS (SELECT scene, n AS p, lead(n) OVER (PARTITION BY scene, wall ORDER BY t, n) AS q FROM so),
ed0 AS MATERIALIZED (SELECT DISTINCT scene, least(p, q) AS a, greatest(p, q) AS b FROM sq WHERE q IS NOT NULL AND p <> q)"""


def _cycles(k: int) -> str:
    """Half edges of edk, their successors clockwise, and by walking on the ring of each."""
    return f"""hf{k} AS (SELECT h.*, atan2(q1.y - p1.y, q1.x - p1.x) AS ang FROM (SELECT scene, a AS p, b AS q FROM ed{k} UNION ALL SELECT scene, b, a FROM ed{k}) h JOIN nd p1 ON p1.id = p JOIN nd q1 ON q1.id = q),
nx{k} AS MATERIALIZED (SELECT scene, q AS p, p AS q, coalesce(lag(q) OVER (PARTITION BY p ORDER BY ang, q), last_value(q) OVER (PARTITION BY p ORDER BY ang, q ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS r FROM hf{k}),
wk{k} AS (SELECT p AS sp, q AS sq, p, q, r, 0 AS n FROM nx{k} UNION ALL SELECT sp, sq, x.p, x.q, x.r, n + 1 FROM wk{k} JOIN nx{k} x ON x.p = wk{k}.q AND x.q = wk{k}.r WHERE NOT (x.p = sp AND x.q = sq)),
rg{k} AS MATERIALIZED (SELECT sp AS p, sq AS q, min((p, q)) AS ring FROM wk{k} GROUP BY sp, sq)"""


_FACES = f"""WITH RECURSIVE {_GRAPH}, {_cycles(0)},
sd AS (SELECT least(p, q) AS a, greatest(p, q) AS b FROM rg0 GROUP BY ALL HAVING count(DISTINCT ring) > 1),
ed1 AS MATERIALIZED (SELECT ed0.* FROM ed0 SEMI JOIN sd ON ed0.a = sd.a AND ed0.b = sd.b), {_cycles(1)},
sg AS MATERIALIZED (SELECT p1.scene, ring, p, q, p1.x AS x0, p1.y AS y0, q1.x AS x1, q1.y AS y1, p1.x * q1.y - q1.x * p1.y AS c FROM rg1 JOIN nd p1 ON p1.id = p JOIN nd q1 ON q1.id = q),
ri AS MATERIALIZED (SELECT scene, ring, sum(c) / 2 AS area, sum((x0 + x1) * c) / 6 AS mx, sum((y0 + y1) * c) / 6 AS my, count(*) AS corners, min(p) AS first FROM sg GROUP BY scene, ring),
ho AS (SELECT o.scene, o.ring, o.area, o.mx, o.my, i.ring AS shell, i.area AS around FROM ri o JOIN nd f ON f.id = o.first JOIN ri i ON i.scene = o.scene AND i.area > 1e-9 WHERE o.area < -1e-9
 AND NOT EXISTS (SELECT 1 FROM sg WHERE sg.ring = i.ring AND sg.p = o.first)
 AND (SELECT count(*) FROM sg WHERE sg.ring = i.ring AND (y0 > f.y) <> (y1 > f.y) AND f.x < (x1 - x0) * (f.y - y0) / (y1 - y0) + x0) % 2 = 1
 QUALIFY row_number() OVER (PARTITION BY o.ring ORDER BY i.area, i.ring) = 1),
hs AS (SELECT shell, sum(area) AS ha, sum(mx) AS hx, sum(my) AS hy, count(*) AS holes FROM ho GROUP BY shell),
fc AS (SELECT scene, ring, area + coalesce(ha, 0) AS area, (mx + coalesce(hx, 0)) / (area + coalesce(ha, 0)) AS cx, (my + coalesce(hy, 0)) / (area + coalesce(ha, 0)) AS cy, corners, coalesce(holes, 0) AS holes FROM ri LEFT JOIN hs ON hs.shell = ri.ring WHERE ri.area > 1e-9 AND ri.area + coalesce(ha, 0) > 1e-9)"""

_ROOMS = """cl AS (SELECT vec_id // 40 AS scene, floor(embedding[5]::DOUBLE * 80)::BIGINT AS cu, floor(embedding[6]::DOUBLE * 80)::BIGINT AS cv, sum(vec_id % 8) AS occupied, sum(vec_id % 5) AS free FROM embeddings GROUP BY ALL),
fr AS (SELECT scene, (cu + 0.5) * 0.25::DOUBLE AS x, (cv + 0.5) * 0.25::DOUBLE AS y FROM cl WHERE free >= 3 AND occupied < 6),
sn AS MATERIALIZED (SELECT fc.*, row_number() OVER (PARTITION BY fc.scene ORDER BY round(cx, 8), round(cy, 8), round(area, 8)) - 1 AS room FROM fc WHERE area >= 1.4 AND EXISTS (SELECT 1 FROM fr WHERE fr.scene = fc.scene AND (SELECT count(*) FROM sg WHERE sg.ring = fc.ring AND (y0 > fr.y) <> (y1 > fr.y) AND fr.x < (x1 - x0) * (fr.y - y0) / (y1 - y0) + x0) % 2 = 1))"""

ORACLES = {
    "wall_stops": f"WITH {_STOPS} SELECT scene, wall, count(*) AS n, round(sum(t), 6) AS t FROM stops GROUP BY ALL",
    "wall_faces": f"""{_FACES},
fa AS (SELECT *, CASE WHEN area < 1.4 THEN 'below-min-area' END AS reason FROM fc)
SELECT scene, CASE WHEN reason IS NULL THEN row_number() OVER (PARTITION BY scene, reason ORDER BY round(cx, 8), round(cy, 8), round(area, 8))::INT - 1 END AS face, round(area + 1e-9, 6) AS area, round(cx, 6) AS cx, round(cy, 6) AS cy, corners::INT AS corners, holes::INT AS holes, reason FROM fa""",
    "room_segments": f"""{_FACES}, {_ROOMS},
ov AS (SELECT sn.scene, sn.room, w.wall, w.len, sum(greatest(0, least(w.len, greatest((sg.x0 - w.x0) * dx + (sg.y0 - w.y0) * dy, (sg.x1 - w.x0) * dx + (sg.y1 - w.y0) * dy)) - greatest(0, least((sg.x0 - w.x0) * dx + (sg.y0 - w.y0) * dy, (sg.x1 - w.x0) * dx + (sg.y1 - w.y0) * dy)))) AS shared
 FROM sn JOIN sg ON sg.ring = sn.ring JOIN w ON w.scene = sn.scene AND abs((sg.x0 - w.x0) * dy - (sg.y0 - w.y0) * dx) <= 1e-6 AND abs((sg.x1 - w.x0) * dy - (sg.y1 - w.y0) * dx) <= 1e-6 GROUP BY ALL),
mb AS (SELECT scene, room, wall FROM ov WHERE shared >= least(0.15, 0.35 * len)),
ne AS (SELECT a.scene, a.room, count(DISTINCT b.room) AS n FROM mb a JOIN mb b ON a.scene = b.scene AND a.wall = b.wall AND a.room <> b.room GROUP BY ALL),
nw AS (SELECT scene, room, count(DISTINCT wall) AS n FROM mb GROUP BY ALL)
SELECT sn.scene, sn.room::INT AS room, 'room_' || (sn.room + 1) AS name, 'wall-face' AS source, round(area + 1e-9, 6) AS area, round(cx, 6) AS cx, round(cy, 6) AS cy, coalesce(nw.n, 0)::INT AS walls, coalesce(ne.n, 0)::INT AS neighbours FROM sn LEFT JOIN nw ON nw.scene = sn.scene AND nw.room = sn.room LEFT JOIN ne ON ne.scene = sn.scene AND ne.room = sn.room""",
    "room_scenes": f"""{_FACES.replace("FROM walls),", "FROM walls WHERE wall % 8 < 3 OR scene % 3 > 0),")}, {_ROOMS},
z AS (SELECT s.scene, (SELECT count(*) FROM fc WHERE fc.scene = s.scene AND area >= 1.4) AS faces, (SELECT count(*) FROM sn WHERE sn.scene = s.scene) AS n, (SELECT count(*) FROM fr WHERE fr.scene = s.scene) AS cells FROM (SELECT DISTINCT scene FROM cl) s)
SELECT scene, n, n = 0 AS fallback, CASE WHEN n = 0 THEN concat_ws('; ', CASE WHEN faces = 0 THEN 'no-bounded-wall-faces' ELSE 'candidate-faces-have-no-observed-floor' END, CASE WHEN cells = 0 THEN 'no-observed-free-cells' ELSE 'no-usable-observed-floor-components' END) END AS reason FROM z""",
    "rasterised_walls": f"""WITH {_WALLS}, p AS (SELECT *, greatest(floor(sqrt((x1 - x0)**2 + (y1 - y0)**2) / 0.5)::BIGINT * 2, 2) AS n FROM walls),
c AS (SELECT DISTINCT scene, floor((x0 + k / (n - 1)::DOUBLE * (x1 - x0) + 8) / 0.5)::BIGINT AS cu, floor((y0 + k / (n - 1)::DOUBLE * (y1 - y0) + 8) / 0.5)::BIGINT AS cv FROM (SELECT *, unnest(range(n)) AS k FROM p)),
d AS (SELECT DISTINCT scene, cu + a AS cu, cv + b AS cv FROM c, (SELECT unnest([-1, 0, 1]) AS a), (SELECT unnest([-1, 0, 1]) AS b) WHERE cu BETWEEN 0 AND 31 AND cv BETWEEN 0 AND 31) SELECT * FROM d WHERE cu BETWEEN 0 AND 31 AND cv BETWEEN 0 AND 31""",
    "probed_walls": f"""WITH {_WALLS}, p AS (SELECT *, sqrt((x1 - x0)**2 + (y1 - y0)**2) AS len, greatest(floor(sqrt((x1 - x0)**2 + (y1 - y0)**2) / 0.5)::BIGINT, 2) AS n FROM walls),
q AS (SELECT scene, wall, n, 0.05::DOUBLE + 0.9::DOUBLE * k / (n - 1)::DOUBLE AS s, side * 0.12::DOUBLE AS o, x0, y0, x1, y1, len FROM (SELECT *, unnest(range(n)) AS k FROM p), (SELECT unnest([1.0::DOUBLE, -1.0]) AS side)),
c AS (SELECT scene, wall, n, floor((x0 + s * (x1 - x0) + (y0 - y1) / len * o) / 0.5)::BIGINT AS cu, floor((y0 + s * (y1 - y0) + (x1 - x0) / len * o) / 0.5)::BIGINT AS cv FROM q)
SELECT scene, wall, (floor(cu / 4.0) * 100 + floor(cv / 4.0))::BIGINT AS room, count(*) AS hits FROM c WHERE cu BETWEEN -40 AND 39 AND cv BETWEEN -40 AND 39 GROUP BY scene, wall, room, n HAVING count(*) >= greatest(3, 0.15 * n)""",
    "outline_rings": f"""{_PLAN}, sides AS (SELECT * FROM (VALUES (0, 0, 0, 0, -1, 1, 0), (1, 1, 0, 1, 0, 0, 1), (2, 1, 1, 0, 1, -1, 0), (3, 0, 1, -1, 0, 0, -1)) t(d, ox, oy, nu, nv, sx, sy)),
ck AS MATERIALIZED (SELECT l.label, cu + ox AS x, cv + oy AS y, d, sx, sy FROM lab l, sides WHERE NOT EXISTS (SELECT 1 FROM lab m WHERE m.label = l.label AND m.cu = l.cu + nu AND m.cv = l.cv + nv)),
nx AS MATERIALIZED (SELECT a.*, b.d AS nd FROM ck a JOIN ck b ON b.label = a.label AND b.x = a.x + a.sx AND b.y = a.y + a.sy QUALIFY row_number() OVER (PARTITION BY a.label, a.x, a.y, a.d ORDER BY (b.d - a.d + 6) % 4 DESC) = 1),
wk AS (SELECT label, x AS ax, y AS ay, d AS ad, x, y, d, x + sx AS ex, y + sy AS ey, nd FROM nx UNION ALL SELECT wk.label, ax, ay, ad, n.x, n.y, n.d, n.x + n.sx, n.y + n.sy, n.nd FROM wk JOIN nx n ON n.label = wk.label AND n.x = ex AND n.y = ey AND n.d = wk.nd WHERE NOT (n.x = ax AND n.y = ay AND n.d = ad)),
rg AS (SELECT label, ax, ay, ad, min((x, y, d)) AS ring FROM wk GROUP BY ALL)
SELECT ck.label, ring[1] AS x, ring[2] AS y, ring[3]::INT AS d, count(*) AS n, round(sum(x * sy - y * sx) / 2, 6)::DOUBLE AS area, round(sum(3 * (x - 0.5::DOUBLE + sx / 2) + y - 0.5::DOUBLE + sy / 2), 6)::DOUBLE AS middles
FROM ck JOIN rg ON rg.label = ck.label AND rg.ax = ck.x AND rg.ay = ck.y AND rg.ad = ck.d GROUP BY ck.label, ring""",
    "rectified_polygons": """WITH RECURSIVE c AS (SELECT vec_id, i, [0, 2, 4, 4, 1, 0][i] + embedding[2 * i - 1]::DOUBLE * 2 AS x, [0, 0, 0, 3, 3, 2][i] + embedding[2 * i]::DOUBLE * 2 AS y FROM embeddings, (SELECT unnest(range(1, 7))::INT AS i)),
s AS (SELECT a.vec_id, a.i, b.x - a.x AS dx, b.y - a.y AS dy, (a.x + b.x) / 2 AS x, (a.y + b.y) / 2 AS y, sqrt((b.x - a.x)**2 + (b.y - a.y)**2) AS w FROM c a JOIN c b ON a.vec_id = b.vec_id AND b.i = a.i % 6 + 1),
g AS (SELECT *, degrees(atan2(abs(dy), abs(dx))) AS ang FROM s WHERE w >= 0.25),
e AS (SELECT vec_id, row_number() OVER (PARTITION BY vec_id ORDER BY i) AS i, count(*) OVER (PARTITION BY vec_id) AS n, CASE WHEN ang < 32 THEN 1 WHEN ang > 58 THEN 0 ELSE dx / w END::DOUBLE AS dx, CASE WHEN ang < 32 THEN 0 WHEN ang > 58 THEN 1 ELSE dy / w END::DOUBLE AS dy, x, y, w FROM g),
f AS (SELECT vec_id, i, n, 1 AS run, dx, dy, x, y, w FROM e WHERE i = 1 UNION ALL
 SELECT e.vec_id, e.i, e.n, CASE WHEN abs(f.dx * e.dx + f.dy * e.dy) > 0.999 THEN run ELSE run + 1 END, CASE WHEN abs(f.dx * e.dx + f.dy * e.dy) > 0.999 THEN f.dx ELSE e.dx END, CASE WHEN abs(f.dx * e.dx + f.dy * e.dy) > 0.999 THEN f.dy ELSE e.dy END,
 CASE WHEN abs(f.dx * e.dx + f.dy * e.dy) > 0.999 THEN (f.x * f.w + e.x * e.w) / (f.w + e.w) ELSE e.x END, CASE WHEN abs(f.dx * e.dx + f.dy * e.dy) > 0.999 THEN (f.y * f.w + e.y * e.w) / (f.w + e.w) ELSE e.y END, CASE WHEN abs(f.dx * e.dx + f.dy * e.dy) > 0.999 THEN f.w + e.w ELSE e.w END FROM f JOIN e ON e.vec_id = f.vec_id AND e.i = f.i + 1),
m AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY vec_id, run ORDER BY i DESC) = 1),
k AS (SELECT a.*, max(run) OVER (PARTITION BY vec_id) AS last FROM m a),
z AS (SELECT a.vec_id, a.last, a.n, abs(a.dx * b.dx + a.dy * b.dy) > 0.999 AND a.last > 2 AS closed, b.x AS bx, b.y AS b2, b.w AS bw FROM k a JOIN k b ON a.vec_id = b.vec_id AND a.run = 1 AND b.run = b.last),
l AS (SELECT k.vec_id, run, z.n, z.last - closed::INT AS lines, dx, dy, CASE WHEN run = 1 AND closed THEN (x * w + bx * bw) / (w + bw) ELSE x END AS x, CASE WHEN run = 1 AND closed THEN (y * w + b2 * bw) / (w + bw) ELSE y END AS y FROM k JOIN z ON z.vec_id = k.vec_id WHERE NOT (closed AND run = z.last)),
q AS (SELECT a.vec_id, a.run, a.lines, b.x AS bx, b.y AS b2, a.x, a.y, a.dx, a.dy, a.dx * b.dy - a.dy * b.dx AS det, ((b.x - a.x) * b.dy - (b.y - a.y) * b.dx) AS num FROM l a JOIN l b ON a.vec_id = b.vec_id AND b.run = a.run % a.lines + 1 WHERE a.n >= 3 AND a.lines >= 3),
p AS (SELECT vec_id, run AS i, CASE WHEN abs(det) >= 1e-9 THEN x + dx * num / det ELSE bx END AS x, CASE WHEN abs(det) >= 1e-9 THEN y + dy * num / det ELSE b2 END AS y FROM q UNION ALL SELECT vec_id, i, x, y FROM c WHERE vec_id NOT IN (SELECT vec_id FROM q)),
o AS (SELECT *, lead(x) OVER w AS nx, lead(y) OVER w AS ny, first_value(x) OVER w AS fx, first_value(y) OVER w AS fy FROM p WINDOW w AS (PARTITION BY vec_id ORDER BY i))
SELECT vec_id, count(*)::INT AS corners, round(sum(x * coalesce(ny, fy) - coalesce(nx, fx) * y) / 2, 6) AS area, round(any_value(fx), 6) AS x, round(any_value(fy), 6) AS y FROM o GROUP BY vec_id""",
}

QUERIES = {f.__name__: f for f in (wall_stops, wall_faces, room_segments, room_scenes, rasterised_walls, probed_walls, outline_rings, rectified_polygons)}
