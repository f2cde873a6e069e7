"""Queries of video frames and their sidecar frames, from the turns of conversations, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.tables import table
from ..streaming import availability
from .series import r6


def _clips(s, d):
    """A conversation is a clip: its turns are frames with times that mostly grow, and sidecar times some milliseconds off; some clips lack a time."""
    c = table(s, d, "conversations").select("conv_id", F.row_number().over(_turns()).alias("n"), F.coalesce(F.length("text"), F.lit(0)).alias("len")).withColumn("n", F.col("n") - 1)
    frames = c.select("conv_id", F.col("n").cast("long").alias("video_index"), F.when(F.pmod(F.col("len"), F.lit(29)) > 0, F.col("n") * 100.0 + F.pmod("len", F.lit(120))).alias("pts_ms"))
    sidecars = c.groupBy("conv_id").agg(F.count("*").cast("int").alias("expected"), F.transform(F.array_sort(F.collect_list(F.struct("n", (F.col("n") * 0.11 + F.pmod("len", F.lit(7)) / 1000.0).alias("t")))), lambda r: r["t"]).alias("times"))
    return frames, sidecars


def _turns():
    from pyspark.sql import Window

    return Window.partitionBy("conv_id").orderBy("turn", "role", F.xxhash64("text"))


def frame_associations(s, d):
    """Each clip's frames with their sidecar frames."""
    x = availability.associated(*_clips(s, d), "conv_id", tolerance=0.06)
    return x.select("conv_id", "video_index", "sidecar_index", *r6("pts_s", "sidecar_s", "delta_s"), "method")


def frame_availability(s, d):
    """What became of each clip's frames."""
    frames, sidecars = _clips(s, d)
    x = availability.availability(availability.associated(frames, sidecars, "conv_id", tolerance=0.06), sidecars, "conv_id")
    return x.select("conv_id", "expected", "decoded", "matched", F.concat_ws(",", F.col("missing").cast("array<string>")).alias("missing"), "pts_status")


_ASSOCIATED = """WITH RECURSIVE c AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role) - 1 AS n, coalesce(length(text), 0) AS len FROM conversations),
f AS MATERIALIZED (SELECT conv_id, n, CASE WHEN len % 29 > 0 THEN (n * 100.0::DOUBLE + len % 120) / 1000.0 END AS pts FROM c),
t AS MATERIALIZED (SELECT conv_id, count(*) AS expected, list(n * 0.11::DOUBLE + (len % 7) / 1000.0::DOUBLE ORDER BY n) AS ts FROM c GROUP BY conv_id),
s AS MATERIALIZED (SELECT conv_id, expected, list_transform(ts, lambda x: x - ts[1]) AS ts, list_sort(ts) = ts AS fine FROM t),
z AS (SELECT conv_id, -1::BIGINT AS n, NULL::DOUBLE AS origin, NULL::DOUBLE AS last, CASE WHEN NOT fine THEN false END AS usable, -1::BIGINT AS used, NULL::BIGINT AS sidecar, NULL::DOUBLE AS rel, NULL::DOUBLE AS there, NULL::DOUBLE AS delta, NULL::VARCHAR AS method, ts, expected FROM s UNION ALL
 SELECT conv_id, n, origin, last, usable, CASE WHEN hit THEN k ELSE used END, CASE WHEN hit THEN k WHEN NOT usable THEN n END, pts - origin, CASE WHEN hit THEN ts[k + 1] END, d, CASE WHEN hit THEN 'pts_nearest' WHEN usable THEN 'pts_unmatched' ELSE 'index_fallback' END, ts, expected FROM (
  SELECT *, coalesce(usable AND d <= 0.06 AND k > used, false) AS hit FROM (SELECT *, CASE WHEN usable THEN abs(ts[k + 1] - (pts - origin)) END AS d FROM (
   SELECT *, CASE WHEN usable THEN CASE WHEN p >= len(ts) THEN p - 1 WHEN p = 0 THEN 0 WHEN abs(ts[p + 1] - (pts - origin)) <= abs(ts[p] - (pts - origin)) THEN p ELSE p - 1 END END AS k FROM (
    SELECT *, CASE WHEN usable THEN len(list_filter(ts, lambda x: x < pts - origin)) END AS p FROM (
     SELECT z.conv_id, f.n, f.pts, z.ts, z.expected, z.used, coalesce(z.usable, true) AND f.pts IS NOT NULL AND coalesce(f.pts > z.last, true) AS usable, CASE WHEN coalesce(z.usable, true) AND f.pts IS NOT NULL THEN f.pts ELSE z.last END AS last,
      CASE WHEN z.origin IS NULL AND coalesce(z.usable, true) AND f.pts IS NOT NULL AND coalesce(f.pts > z.last, true) THEN f.pts ELSE z.origin END AS origin FROM z JOIN f ON f.conv_id = z.conv_id AND f.n = z.n + 1))))))"""

ORACLES = {
    "frame_associations": _ASSOCIATED + " SELECT conv_id, n AS video_index, sidecar AS sidecar_index, round(rel, 6) AS pts_s, round(there, 6) AS sidecar_s, round(delta, 6) AS delta_s, method FROM z WHERE n >= 0",
    "frame_availability": _ASSOCIATED + """, a AS (SELECT conv_id, expected, count(*) AS decoded, count(sidecar) AS matched, list(sidecar) FILTER (sidecar IS NOT NULL) AS have, bool_or(method = 'index_fallback') AS fell FROM z WHERE n >= 0 GROUP BY ALL)
SELECT conv_id, expected::INT AS expected, decoded, matched, array_to_string(list_filter(range(expected), lambda i: NOT list_contains(coalesce(have, []), i)), ',') AS missing, CASE WHEN fell THEN 'index_fallback' ELSE 'used' END AS pts_status FROM a""",
}

QUERIES = {f.__name__: f for f in (frame_associations, frame_availability)}
