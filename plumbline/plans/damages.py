"""Queries from detections to damage regions, laid out by the embeddings, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import damage
from ..sources.tables import table
from .series import r6

_e = lambda i: F.col("embedding")[i].cast("double")
_n = F.lit


def _scene(s, d):
    """Detections, pixels, cameras, walls and levels: 250 rows are a capture of two frames, one facing each of two walls."""
    x = table(s, d, "embeddings").select(F.expr("vec_id div 250").alias("capture"), F.pmod("vec_id", F.lit(2)).alias("frame"), F.col("vec_id").alias("det"), F.floor((_e(0) + 0.5) * 64).alias("u"), F.floor((_e(1) + 0.5) * 48).alias("v"), (2 + _e(2) * 0.4).alias("depth"), "label", "embedding")
    pick = lambda n, *v: F.element_at(F.array(*[F.lit(w) for w in v]), (F.pmod(F.expr(f"det div {n}"), F.lit(len(v))) + 1).cast("int"))
    detections = x.select("capture", "frame", "det", *[(F.col(c) + k).alias(n) for n, c, k in (("x0", "u", -8), ("x1", "u", 9), ("y0", "v", -6), ("y1", "v", 7))], pick(2, "water", "fire", "water", "mold", "furniture").alias("class"), (0.4 + F.abs(_e(3))).alias("confidence"), F.concat(F.lit("seen "), "det").alias("evidence"), pick(4, "sam", "box").alias("method"), F.col("det").alias("place"), pick(3, "stain", "char", None).alias("subtype"))
    pixels = x.select("capture", "frame", "u", "v", "depth").groupBy("capture", "frame", "u", "v").agg(F.min("depth").alias("depth"))
    rows = {0: (0, 0, 1, 0, 1, 0, 0, 0, 0, -1, 0, 1.2, 0, 0, 0, 1), 1: (1, 0, 0, 0, 0, 0, 1, 0, 0, -1, 0, 1.2, 0, 0, 0, 1)}
    pose = F.when(F.col("frame") == 0, F.array(*[F.lit(float(v)) for v in rows[0]])).otherwise(F.array(*[F.lit(float(v)) for v in rows[1]]))
    cameras = x.select("capture", "frame").distinct().select("capture", "frame", pose.alias("pose"), _n(32.0).alias("fx"), _n(32.0).alias("fy"), _n(32.0).alias("cx"), _n(24.0).alias("cy"))
    captures = x.select("capture").distinct()
    wall = lambda name, x0, y0, x1, y1: F.struct(_n(name).alias("surface"), *[_n(float(v)).alias(k) for k, v in zip(("x0", "y0", "x1", "y1", "base", "width", "height"), (x0, y0, x1, y1, 0, 4, 2.5), strict=True)])
    walls = captures.select("capture", F.explode(F.array(wall("east", 2, -2, 2, 2), wall("north", -2, 2, 2, 2))).alias("w")).select("capture", "w.*")
    levels = captures.select("capture", F.explode(F.array(F.struct(_n("floor").alias("surface"), _n(0.0).alias("z")), F.struct(_n("roof").alias("surface"), _n(2.5).alias("z")))).alias("l")).select("capture", "l.*")
    return detections, pixels, cameras, walls, levels


def projected_boxes(s, d):
    """What each detection's pixels hit: points on each surface, and their mean place on it."""
    detections, pixels, cameras, walls, levels = _scene(s, d)
    a = damage.assigned_points(damage.project_boxes(detections, pixels, cameras), walls, levels)
    return a.groupBy("capture", "surface", "det").agg(F.count("*").alias("n"), *[F.round(F.avg(c), 6).alias(c) for c in ("u", "v", "incidence")])


def damage_regions(s, d):
    """Regions of damage of every capture."""
    x = damage.damage_pass(*_scene(s, d), ["subtype"], resolution=0.25, area=0.1, radius=1)
    return x.select("capture", "id", "damage_class", F.concat_ws("+", "combined").alias("combined"), *r6("area", "u0", "u1", "v0", "v1"), "views", *r6("confidence"), F.concat_ws(",", F.col("frames").cast("array<string>")).alias("frames"), F.concat_ws(";", "evidence").alias("evidence"), "methods", "subtype")


_ASSIGNED = """WITH RECURSIVE e AS (SELECT vec_id // 250 AS capture, vec_id % 2 AS frame, vec_id AS det, floor((embedding[1]::DOUBLE + 0.5) * 64)::BIGINT AS u, floor((embedding[2]::DOUBLE + 0.5) * 48)::BIGINT AS v, 2 + embedding[3]::DOUBLE * 0.4 AS depth, 0.4 + abs(embedding[4]::DOUBLE) AS confidence,
 ['water', 'fire', 'water', 'mold', 'furniture'][(vec_id // 2 % 5 + 1)::INT] AS cls, ['sam', 'box'][(vec_id // 4 % 2 + 1)::INT] AS method, ['stain', 'char', NULL][(vec_id // 3 % 3 + 1)::INT] AS subtype FROM embeddings),
px AS (SELECT capture, frame, u, v, min(depth) AS d FROM e GROUP BY ALL),
pt AS (SELECT p.capture, p.frame, e.det, p.u AS pu, p.v AS pv, (p.u - 32) * d / 32 AS a, (p.v - 24) * d / 32 AS b, d FROM px p JOIN e ON e.capture = p.capture AND e.frame = p.frame AND p.u BETWEEN e.u - 8 AND e.u + 8 AND p.v BETWEEN e.v - 6 AND e.v + 6 {where}),
wd AS (SELECT *, CASE WHEN frame = 0 THEN d ELSE a END AS x, CASE WHEN frame = 0 THEN a ELSE d END AS y, 1.2 - b AS z, sqrt(a * a + b * b + d * d) AS size FROM pt),
cd AS (SELECT capture, frame, det, pu, pv, 'east' AS surface, y + 2 AS u, z AS v, abs(x - 2) AS off, abs(CASE WHEN frame = 0 THEN d ELSE a END / size) AS inc FROM wd WHERE y + 2 > -0.1 AND y + 2 < 4.1
 UNION ALL SELECT capture, frame, det, pu, pv, 'north', x + 2, z, abs(y - 2), abs(CASE WHEN frame = 0 THEN a ELSE d END / size) FROM wd WHERE x + 2 > -0.1 AND x + 2 < 4.1
 UNION ALL SELECT capture, frame, det, pu, pv, 'floor', NULL, NULL, abs(z), abs(b / size) FROM wd UNION ALL SELECT capture, frame, det, pu, pv, 'roof', NULL, NULL, abs(z - 2.5), abs(b / size) FROM wd),
asg AS MATERIALIZED (SELECT * FROM cd WHERE off < 0.12 QUALIFY row_number() OVER (PARTITION BY capture, frame, det, pu, pv ORDER BY off, surface) = 1)"""

ORACLES = {
    "projected_boxes": _ASSIGNED.replace("{where}", "") + " SELECT capture, surface, det, count(*) AS n, round(avg(u), 6) AS u, round(avg(v), 6) AS v, round(avg(inc), 6) AS incidence FROM asg GROUP BY ALL",
    "damage_regions": _ASSIGNED.replace("{where}", "WHERE e.confidence >= 0.5 AND e.cls <> 'furniture'") + """,
wt AS (SELECT capture, surface, det, avg(inc) AS w FROM asg GROUP BY ALL HAVING avg(inc) >= 0.26),
vt AS (SELECT a.capture, a.surface, floor(u / 0.25)::BIGINT AS cu, floor(v / 0.25)::BIGINT AS cv, a.det, w FROM asg a JOIN wt ON wt.capture = a.capture AND wt.surface = a.surface AND wt.det = a.det WHERE u >= 0 AND u < 4 AND v >= 0 AND v < 2.5),
ce AS (SELECT capture, surface, cu, cv, count(*) AS views, sum(w) AS w FROM vt GROUP BY ALL),
st AS (SELECT a.i AS du, b.i AS dv FROM (SELECT unnest([-1, 0, 1]) AS i) a, (SELECT unnest([-1, 0, 1]) AS i) b),
di AS (SELECT DISTINCT capture, surface, cu + du AS cu, cv + dv AS cv FROM ce, st WHERE views >= 2 AND w >= 0.6 AND cu + du BETWEEN 0 AND 15 AND cv + dv BETWEEN 0 AND 9),
cl AS (SELECT capture, surface, cu + du AS cu, cv + dv AS cv FROM di, st GROUP BY ALL HAVING count(*) = 9),
bl AS (SELECT capture, surface, cu - a AS cu, cv - b AS cv FROM cl, (SELECT unnest([0, 1]) AS a), (SELECT unnest([0, 1]) AS b) GROUP BY ALL HAVING count(*) = 4),
op AS MATERIALIZED (SELECT DISTINCT capture, surface, cu + a AS cu, cv + b AS cv FROM bl, (SELECT unnest([0, 1]) AS a), (SELECT unnest([0, 1]) AS b)),
rc AS (SELECT capture, surface, cu * 100 + cv AS root, cu, cv FROM op UNION SELECT rc.capture, rc.surface, root, o.cu, o.cv FROM rc JOIN op o ON o.capture = rc.capture AND o.surface = rc.surface AND abs(o.cu - rc.cu) + abs(o.cv - rc.cv) = 1),
lb AS (SELECT capture, surface, cu, cv, min(root) AS label FROM rc GROUP BY ALL),
pa AS (SELECT lb.capture, lb.surface, label, count(*) AS n, min(lb.cu) AS a, max(lb.cu) + 1 AS b, min(lb.cv) AS c, max(lb.cv) + 1 AS d, max(coalesce(views, 0)) AS views, avg(coalesce(w, 0)) AS mean FROM lb LEFT JOIN ce ON ce.capture = lb.capture AND ce.surface = lb.surface AND ce.cu = lb.cu AND ce.cv = lb.cv GROUP BY ALL),
nb AS (SELECT *, row_number() OVER (PARTITION BY capture, surface ORDER BY label) AS num FROM pa),
tl AS (SELECT vt.capture, vt.surface, label, cls, sum(w * confidence) AS w FROM vt JOIN lb ON lb.capture = vt.capture AND lb.surface = vt.surface AND lb.cu = vt.cu AND lb.cv = vt.cv JOIN e ON e.det = vt.det GROUP BY ALL),
tr AS (SELECT *, row_number() OVER (PARTITION BY capture, surface, label ORDER BY w DESC, cls) AS k FROM tl),
tp AS (SELECT capture, surface, label, max(cls) FILTER (k = 1) AS top, CASE WHEN coalesce(max(w) FILTER (k = 2) >= 0.4 * max(w) FILTER (k = 1), false) THEN max(cls) FILTER (k = 2) END AS second FROM tr GROUP BY ALL),
gv AS (SELECT DISTINCT vt.capture, vt.surface, vt.det, w, cls, confidence, method, subtype, frame FROM vt JOIN e ON e.det = vt.det),
cs AS (SELECT capture, surface, cls, avg(confidence) AS conf, list_sort(list(DISTINCT frame)) AS frames, list('seen ' || det ORDER BY det)[:4] AS evidence FROM gv GROUP BY ALL),
su AS (SELECT capture, surface, cls, subtype FROM (SELECT capture, surface, cls, subtype, sum(w * confidence) AS w, min(det) AS p FROM gv WHERE subtype IS NOT NULL GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY capture, surface, cls ORDER BY w DESC, p) = 1),
mt AS (SELECT capture, surface, string_agg(DISTINCT method, ',' ORDER BY method) AS methods FROM gv GROUP BY ALL),
j AS (SELECT nb.*, top, second, p.conf AS pc, q.conf AS qc, p.frames AS pf, q.frames AS qf, p.evidence AS pe, q.evidence AS qe, methods, ps.subtype AS s1, qs.subtype AS s2 FROM nb LEFT JOIN tp ON tp.capture = nb.capture AND tp.surface = nb.surface AND tp.label = nb.label
 LEFT JOIN cs p ON p.capture = nb.capture AND p.surface = nb.surface AND p.cls = top LEFT JOIN cs q ON q.capture = nb.capture AND q.surface = nb.surface AND q.cls = second LEFT JOIN su ps ON ps.capture = nb.capture AND ps.surface = nb.surface AND ps.cls = top LEFT JOIN su qs ON qs.capture = nb.capture AND qs.surface = nb.surface AND qs.cls = second LEFT JOIN mt ON mt.capture = nb.capture AND mt.surface = nb.surface WHERE n * 0.0625 >= 0.1)
SELECT capture, surface || '#' || num AS id, CASE WHEN second IS NULL THEN coalesce(top, 'water') ELSE 'combined' END AS damage_class, CASE WHEN second IS NULL THEN '' ELSE top || '+' || second END AS combined, round(n * 0.0625, 6)::DOUBLE AS area, round(a * 0.25, 6)::DOUBLE AS u0, round(b * 0.25, 6)::DOUBLE AS u1, round(c * 0.25, 6)::DOUBLE AS v0, round(d * 0.25, 6)::DOUBLE AS v1, views,
 round(least(1, greatest(0, 0.5 * (1 - exp(-0.55 * greatest(views - 1, 0))) + 0.25 * least(1, mean / 3) + 0.25 * CASE WHEN qc IS NULL THEN pc ELSE (pc + qc) / 2 END)), 6) AS confidence, array_to_string(list_sort(list_distinct(list_concat(pf, coalesce(qf, [])))), ',') AS frames, array_to_string(list_concat(pe, coalesce(qe, []))[:4], ';') AS evidence, methods, coalesce(s1, s2) AS subtype FROM j""",
}

QUERIES = {f.__name__: f for f in (projected_boxes, damage_regions)}
