"""Queries of rooms, their walls and openings, laid out by the embeddings, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import openings, rooms
from ..sources.tables import table
from .series import r6

_e = lambda i: F.col("embedding")[i].cast("double")
_quarters = lambda c: F.floor(c) / 4


def _boxes(s, d):
    """(scene, id, x0, y0, x1, y1, polygon): twenty rectangular rooms a scene, in quarters of a metre."""
    x = table(s, d, "embeddings").select(F.expr("vec_id div 20").alias("scene"), F.col("vec_id").alias("id"), _quarters(_e(0) * 80).alias("x0"), _quarters(_e(1) * 80).alias("y0"), (2 + _quarters(F.abs(_e(2)) * 40)).alias("w"), (2 + _quarters(F.abs(_e(3)) * 40)).alias("h"), "embedding")
    x = x.withColumn("x1", F.col("x0") + F.col("w")).withColumn("y1", F.col("y0") + F.col("h"))
    at = lambda a, b: F.struct(F.col(a).alias("x"), F.col(b).alias("y"))
    return x.withColumn("polygon", F.array(at("x0", "y0"), at("x1", "y0"), at("x1", "y1"), at("x0", "y1")))


def room_overlaps(s, d):
    """Rooms of a scene that share more than a hundredth of the smaller one."""
    return rooms.room_overlaps(_boxes(s, d), "scene").select("scene", "a", "b", *r6("fraction"))


def observed_rooms(s, d):
    """Rooms that hold the middle of a free cell."""
    cells = _boxes(s, d).select("scene", (_e(4) * 20 + 0.01).alias("x"), (_e(5) * 20 + 0.01).alias("y"))
    return rooms.observed_rooms(_boxes(s, d), cells, "scene").select("scene", "id")


def shared_boundary(s, d):
    """Walls along the lower side of every room, and the rooms of whose boundary they are part."""
    b = _boxes(s, d)
    walls = b.select("scene", F.col("id").alias("wall"), "x0", "y0", (F.col("x0") + 3).alias("x1"), F.col("y0").alias("y1"))
    return rooms.shared_boundary(walls, b, "scene").select("scene", "wall", "room", *r6("shared"))


def wall_names(s, d):
    """Names of four walls of each room by the side of the room that they are on."""
    x = table(s, d, "embeddings").select(F.expr("vec_id div 40").alias("scene"), F.expr("vec_id div 4").alias("room"), F.concat(F.lit("room_"), F.expr("vec_id div 4")).alias("room_name"), F.col("vec_id").alias("wall"), *[_e(i).alias(c) for i, c in enumerate(("rx", "ry", "nx", "ny", "mx", "my"))], F.abs(_e(6)).alias("length"))
    return rooms.wall_names(x, "scene").select("scene", "room", "wall", "name")


def adjacency_via(s, d):
    """The wall with the nearest door between two rooms."""
    x = table(s, d, "embeddings").select(F.expr("vec_id div 40").alias("scene"), F.col("vec_id").alias("i"), "embedding")
    edges = x.select("scene", F.pmod("i", F.lit(8)).alias("a"), F.pmod("i", F.lit(7)).alias("b"), "i", _e(0).alias("x"), _e(1).alias("y")).where("a <> b and i % 5 = 0").groupBy("scene", "a", "b").agg(F.min_by("x", "i").alias("x"), F.min_by("y", "i").alias("y"))
    kind = F.when(F.pmod("i", F.lit(3)) == 0, "door").when(F.pmod("i", F.lit(3)) == 1, "pass-through").otherwise("window")
    doors = x.select("scene", F.col("i").alias("place"), kind.alias("kind"), F.pmod("i", F.lit(8)).alias("room"), F.concat(F.lit("w"), F.col("i")).alias("name"), (_e(2) * 2).alias("mx"), (_e(3) * 2).alias("my"))
    return rooms.adjacency_via(edges, doors, "scene", 0.4)


def adjacency_errors(s, d):
    """Neighbour lists that are not mutual, name themselves or unknown rooms."""
    x = table(s, d, "embeddings").select(F.expr("vec_id div 10").alias("scene"), F.pmod("vec_id", F.lit(10)).alias("id"), "embedding")
    near = lambda i, n: (F.floor(F.abs(_e(i)) * 100) % n).cast("long")
    r = x.select("scene", "id", F.array_distinct(F.array(near(0, 11), near(1, 10))).alias("neighbours"))
    edges = x.select("scene", near(2, 12).alias("a"), near(3, 12).alias("b")).distinct()
    return rooms.adjacency_errors(r, edges, "scene")


def _openings(s, d):
    i = F.col("vec_id")
    span = lambda k: F.struct((_e(k) * 6).alias("low"), (_e(k) * 6 + 0.5 + F.abs(_e(k + 1))).alias("high"))
    pick = lambda n, *v: F.element_at(F.array(*[F.lit(w) for w in v]), (F.pmod(F.expr(f"vec_id div {n}"), F.lit(len(v))) + 1).cast("int"))
    return table(s, d, "embeddings").select(
        F.col("label").alias("scene"), i.alias("id"), F.when(F.pmod(i, F.lit(13)) > 0, F.expr("vec_id div 10") % 2).cast("int").alias("wall"), pick(20, "door", "window").alias("kind"), span(0).alias("u"), F.when(F.pmod(i, F.lit(7)) > 0, span(2)).alias("v"), F.abs(_e(4) * 2).alias("confidence"),
        F.array(pick(10, "rgb", "geometry", "furniture")).alias("provenance"), F.when(F.pmod(i, F.lit(5)) > 0, "measured").otherwise("unmeasured").alias("state"), F.create_map(F.lit("u_sigma_m"), _e(5)).alias("sigma"), F.array(i.cast("int")).alias("frames"), F.lit(1).cast("long").alias("count"),
        F.pmod(i, F.lit(9)).cast("long").alias("support"), pick(10, "box", "mask").alias("method"), F.abs(_e(6)).alias("wall_confidence"), F.when(F.pmod(i, F.lit(3)) > 0, F.abs(_e(7))).alias("wall_distance"),
    )


def fused_openings(s, d):
    """Openings of several sources made one, and the hints that stay."""
    x = openings.fuse_openings(_openings(s, d), "scene")
    return x.select("scene", "wall", "kind", F.round("u.low", 6).alias("u0"), F.round("u.high", 6).alias("u1"), F.round("v.low", 6).alias("v0"), *r6("confidence", "wall_confidence", "wall_distance"), F.concat_ws(",", "provenance").alias("sources"), "state", F.round(F.col("sigma")["u_sigma_m"], 6).alias("sigma"), F.round(F.col("sigma")["u_spread_m"], 6).alias("spread"), F.concat_ws(",", F.col("frames").cast("array<string>")).alias("frames"), "count", "support", "method", "basis")


_BOXES = """b AS (SELECT vec_id // 20 AS scene, vec_id AS id, floor(embedding[1]::DOUBLE * 80) / 4 AS x0, floor(embedding[2]::DOUBLE * 80) / 4 AS y0, floor(embedding[1]::DOUBLE * 80) / 4 + 2 + floor(abs(embedding[3]::DOUBLE) * 40) / 4 AS x1, floor(embedding[2]::DOUBLE * 80) / 4 + 2 + floor(abs(embedding[4]::DOUBLE) * 40) / 4 AS y1, embedding[5]::DOUBLE * 20 + 0.01 AS px, embedding[6]::DOUBLE * 20 + 0.01 AS py FROM embeddings)"""
_SHARE = "coalesce(greatest(0, least(z.{k}h, n.{k}h) - greatest(z.{k}l, n.{k}l)) / nullif(greatest(z.{k}h, n.{k}h) - least(z.{k}l, n.{k}l), 0) >= 0.15, false)"
_NEAR = "abs(z.{k}l + z.{k}h - n.{k}l - n.{k}h) / 2 <= 0.35"
_HEAD = f"list_transform(range(1, len(hs) + 1), lambda j: ({_NEAR.format(k='u')} AND {_NEAR.format(k='v')}) OR ({_SHARE.format(k='u')} AND {_SHARE.format(k='v')}))".replace("z.", "hs[j].")
_HINT = "coalesce(len(list_filter(ks, lambda o: greatest(0, least(o.h, n.h) - greatest(o.l, n.l)) / nullif(greatest(o.h, n.h) - least(o.l, n.l), 0) >= 0.15)) = 0, true)"

ORACLES = {
    "room_overlaps": f"WITH {_BOXES}, o AS (SELECT p.scene, p.id AS a, q.id AS b, (least(p.x1, q.x1) - greatest(p.x0, q.x0)) AS w, (least(p.y1, q.y1) - greatest(p.y0, q.y0)) AS h, least((p.x1 - p.x0) * (p.y1 - p.y0), (q.x1 - q.x0) * (q.y1 - q.y0)) AS s FROM b p JOIN b q ON p.scene = q.scene AND p.id < q.id) SELECT scene, a, b, round(w * h / s, 6) AS fraction FROM o WHERE w > 0 AND h > 0 AND w * h / s > 0.01",
    "observed_rooms": f"WITH {_BOXES} SELECT scene, id FROM b r WHERE EXISTS (SELECT 1 FROM b c WHERE c.scene = r.scene AND c.px BETWEEN r.x0 AND r.x1 AND c.py BETWEEN r.y0 AND r.y1)",
    "shared_boundary": f"""WITH {_BOXES}, e AS (SELECT scene, id AS room, x0, x1, y0 AS y FROM b UNION ALL SELECT scene, id, x0, x1, y1 FROM b),
o AS (SELECT b.scene, b.id AS wall, room, sum(greatest(0, least(b.x0 + 3, e.x1) - greatest(b.x0, e.x0))) AS shared FROM b JOIN e ON b.scene = e.scene AND e.y = b.y0 GROUP BY ALL) SELECT scene, wall, room, round(shared, 6) AS shared FROM o WHERE shared >= 0.15""",
    "wall_names": """WITH w AS (SELECT vec_id // 40 AS scene, vec_id // 4 AS room, vec_id AS wall, abs(embedding[7]::DOUBLE) AS l, CASE WHEN (embedding[1]::DOUBLE - embedding[5]) * embedding[3] + (embedding[2]::DOUBLE - embedding[6]) * embedding[4] < 0 THEN 1 ELSE -1 END AS s, embedding[3]::DOUBLE AS nx, embedding[4]::DOUBLE AS ny FROM embeddings),
n AS (SELECT *, 'room_' || room || '.' || ['north','northeast','east','southeast','south','southwest','west','northwest'][(floor(((degrees(atan2(s * nx, s * ny)) + 360) % 360 + 22.5) / 45)::BIGINT % 8 + 1)::INT] || '_wall' AS base FROM w),
k AS (SELECT *, row_number() OVER (PARTITION BY scene, room, base ORDER BY l DESC, wall) AS k FROM n) SELECT scene, room, wall, base || CASE WHEN k > 1 THEN '_' || k ELSE '' END AS name FROM k""",
    "adjacency_via": """WITH x AS (SELECT vec_id // 40 AS scene, vec_id AS i, embedding::DOUBLE[] AS e FROM embeddings),
g AS (SELECT scene, i % 8 AS a, i % 7 AS b, e[1] AS x, e[2] AS y FROM x WHERE i % 8 <> i % 7 AND i % 5 = 0 QUALIFY row_number() OVER (PARTITION BY scene, i % 8, i % 7 ORDER BY i) = 1),
o AS (SELECT scene, i, i % 8 AS room, 2 * e[3] AS mx, 2 * e[4] AS my FROM x WHERE i % 3 < 2),
n AS (SELECT g.scene, g.a, g.b, 'w' || o.i AS via FROM g JOIN o ON o.scene = g.scene AND o.room IN (g.a, g.b) WHERE sqrt((mx - g.x)**2 + (my - g.y)**2) < 0.4 QUALIFY row_number() OVER (PARTITION BY g.scene, g.a, g.b ORDER BY sqrt((mx - g.x)**2 + (my - g.y)**2), o.i) = 1)
SELECT g.scene, g.a, g.b, via FROM g LEFT JOIN n ON n.scene = g.scene AND n.a = g.a AND n.b = g.b""",
    "adjacency_errors": """WITH x AS (SELECT vec_id // 10 AS scene, vec_id % 10 AS id, list_transform(embedding, lambda v: floor(abs(v::DOUBLE) * 100)::BIGINT) AS e FROM embeddings),
l AS (SELECT DISTINCT scene, id AS room, unnest([e[1] % 11, e[2] % 10]) AS other FROM x),
g AS (SELECT DISTINCT scene, e[3] % 12 AS a, e[4] % 12 AS b FROM x),
z AS (SELECT scene, room, other, CASE WHEN room = other THEN 'self' WHEN (scene, other) NOT IN (SELECT (scene, id) FROM x) THEN 'unknown' WHEN (scene, other, room) NOT IN (SELECT (scene, room, other) FROM l) THEN 'asymmetric' END AS error FROM l)
SELECT * FROM z WHERE error IS NOT NULL UNION ALL SELECT scene, a, b, 'edge to unknown room' FROM g WHERE (scene, a) NOT IN (SELECT (scene, id) FROM x) OR (scene, b) NOT IN (SELECT (scene, id) FROM x)""",
    "fused_openings": f"""WITH RECURSIVE x AS (SELECT label AS scene, vec_id AS id, CASE WHEN vec_id % 13 > 0 THEN vec_id // 10 % 2 END AS wall, ['door', 'window'][(vec_id // 20 % 2 + 1)::INT] AS kind, embedding::DOUBLE[] AS e FROM embeddings),
o AS (SELECT *, e[1] * 6 AS ul, e[1] * 6 + 0.5 + abs(e[2]) AS uh, e[3] * 6 AS vl, e[3] * 6 + 0.5 + abs(e[4]) AS vh, abs(e[5] * 2) AS c, id % 7 > 0 AS has_v, id % 5 > 0 AND wall IS NOT NULL AND id % 7 > 0 AS measured, ['rgb', 'geometry', 'furniture'][(id // 10 % 3 + 1)::INT] AS source, ['box', 'mask'][(id // 10 % 2 + 1)::INT] AS method FROM x),
m AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY scene, wall, kind ORDER BY ul, uh, id) AS k FROM o WHERE measured),
f AS (SELECT scene, wall, kind, k, id, 1 AS grp, [{{'ul': ul, 'uh': uh, 'vl': vl, 'vh': vh}}] AS hs FROM m WHERE k = 1 UNION ALL
 SELECT q.scene, q.wall, q.kind, q.k, q.id, coalesce(nullif(pos, 0), len(hs) + 1)::INT, CASE WHEN pos > 0 THEN hs ELSE list_append(hs, {{'ul': ul, 'uh': uh, 'vl': vl, 'vh': vh}}) END FROM (SELECT n.*, f.hs, coalesce(list_position({_HEAD}, true), 0) AS pos FROM f JOIN m n ON n.scene = f.scene AND n.wall = f.wall AND n.kind = f.kind AND n.k = f.k + 1) q),
u AS (SELECT m.*, f.grp, greatest(0.05, c) AS w FROM m JOIN f ON f.scene = m.scene AND f.id = m.id),
s AS (SELECT scene, wall, kind, grp, list_distinct(list_filter(list(source ORDER BY k), lambda v: v <> 'furniture')) AS known, list_filter(list(source ORDER BY k), lambda v: v <> 'furniture') AS raw, count(*) AS n FROM u GROUP BY ALL),
p AS (SELECT *, CASE WHEN len(raw) = 0 THEN ['geometry'] WHEN len(known) = 2 THEN [raw[1], CASE raw[1] WHEN 'rgb' THEN 'geometry' ELSE 'rgb' END] ELSE [raw[1]] END AS src FROM s),
g AS (SELECT u.scene, u.wall, u.kind, u.grp, sum(w * ul) / sum(w) AS ul, sum(w * uh) / sum(w) AS uh, sum(w * vl) / sum(w) AS vl, least(1, greatest(max(c), 1 - product(1 - c))) AS c, max(abs(e[7])) AS wc, min(CASE WHEN id % 3 > 0 THEN abs(e[8]) END) AS wd, arg_min(e[6], k) AS sigma, stddev_pop((ul + uh) / 2) AS spread, string_agg(id::VARCHAR, ',' ORDER BY k) AS frames, count(*) AS n, sum(id % 9)::BIGINT AS support, CASE WHEN count(DISTINCT method) > 1 THEN 'fused' ELSE any_value(method) END AS method FROM u GROUP BY ALL),
fu AS (SELECT g.scene, g.wall, g.kind, ul, uh, vl, c, wc, wd, array_to_string(CASE WHEN p.n > 1 OR len(src) > 1 THEN list_append(src, 'fused') ELSE src END, ',') AS sources, 'measured' AS state, sigma, spread, frames, g.n, support, method, 'fused geometry/RGB/RoomFormer-supported observations' AS basis FROM g JOIN p ON p.scene = g.scene AND p.wall = g.wall AND p.kind = g.kind AND p.grp = g.grp),
h AS MATERIALIZED (SELECT *, coalesce(wall, -1) AS wl, ul AS l, uh AS h, row_number() OVER (PARTITION BY scene, wall, kind ORDER BY id) AS k FROM o WHERE NOT measured),
hf AS (SELECT h.scene, h.wl, h.kind, 0::BIGINT AS k, NULL::BIGINT AS id, false AS stay, coalesce((SELECT list({{'l': fu.ul, 'h': fu.uh}}) FROM fu WHERE fu.scene = h.scene AND fu.wall = h.wl AND fu.kind = h.kind), []::STRUCT(l DOUBLE, h DOUBLE)[]) AS ks FROM (SELECT DISTINCT scene, wl, kind FROM h) h UNION ALL
 SELECT q.scene, q.wl, q.kind, q.k, q.id, q.ok, CASE WHEN ok THEN list_append(ks, {{'l': l, 'h': q.h}}) ELSE ks END FROM (SELECT n.*, hf.ks, {_HINT} AS ok FROM hf JOIN h n ON n.scene = hf.scene AND n.wl = hf.wl AND n.kind = hf.kind AND n.k = hf.k + 1) q),
a AS (SELECT * FROM fu UNION ALL SELECT h.scene, h.wall, h.kind, ul, uh, CASE WHEN has_v THEN vl END, c, abs(e[7]), CASE WHEN h.id % 3 > 0 THEN abs(e[8]) END, source, CASE WHEN h.id % 5 > 0 THEN 'measured' ELSE 'unmeasured' END, e[6], NULL, h.id::VARCHAR, 1, h.id % 9, method, NULL FROM h JOIN hf ON hf.id = h.id AND hf.stay)
SELECT scene, wall::INT AS wall, kind, round(ul, 6) AS u0, round(uh, 6) AS u1, round(vl, 6) AS v0, round(c, 6) AS confidence, round(wc, 6) AS wall_confidence, round(wd, 6) AS wall_distance, sources, state, round(sigma, 6) AS sigma, round(spread, 6) AS spread, frames, n AS count, support, method, basis FROM a""",
}

QUERIES = {f.__name__: f for f in (room_overlaps, observed_rooms, shared_boundary, wall_names, adjacency_via, adjacency_errors, fused_openings)}
