"""Fits of lines and planes from sums, and scores of given hypotheses."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import line_angle


def tls_lines(df: DataFrame, key: str, x: str, y: str) -> DataFrame:
    """(key, n, angle, offset, rms): total-least-squares lines, from one aggregation of moments."""
    m = df.groupBy(key).agg(F.count("*").alias("n"), F.avg(x).alias("mx"), F.avg(y).alias("my"), F.covar_pop(x, y).alias("sxy"), F.pow(F.stddev_pop(x), 2).alias("sxx"), F.pow(F.stddev_pop(y), 2).alias("syy"))
    m = m.withColumn("angle", line_angle(F.col("sxx"), F.col("syy"), F.col("sxy")))
    s, c = F.sin("angle"), F.cos("angle")
    rest = s * s * F.col("sxx") - 2 * s * c * F.col("sxy") + c * c * F.col("syy")
    return m.select(key, "n", "angle", (c * F.col("my") - s * F.col("mx")).alias("offset"), F.sqrt(F.greatest(F.lit(0.0), rest)).alias("rms"))


def best_line(df: DataFrame, key: str, x: str, y: str, lines: DataFrame, threshold: float) -> DataFrame:
    """(key, line, inliers): which of lines(line, angle) through each key's mean point has most points near it."""
    mean = df.groupBy(key).agg(F.avg(x).alias("mx"), F.avg(y).alias("my"))
    from .joins import small

    z = df.join(mean, key).crossJoin(small(lines))
    near = F.abs(F.cos("angle") * (F.col(y) - F.col("my")) - F.sin("angle") * (F.col(x) - F.col("mx"))) <= threshold
    score = z.groupBy(key, "line").agg(F.count_if(near).alias("inliers"))
    return score.groupBy(key).agg(F.max(F.struct("inliers", (-F.col("line")).alias("l"))).alias("m")).select(key, (-F.col("m.l")).alias("line"), F.col("m.inliers").alias("inliers"))


def best_pair_line(df: DataFrame, key: str, id_: str, x: str, y: str, threshold: float, tries: int = 300, apart: float = 0.3, seed: int = 7) -> DataFrame:
    """(key, line, angle, offset, inliers): of `tries` lines through two of each key's own points, the one with most points near it.

    The first point of a try is drawn from the key's points and the second from those at least
    `apart` from it, both by seeded hashes of ids, so that the draw is an aggregation; a try
    without such a point is left out. Of equals the first line counts.
    """
    from .joins import small

    p = df.select(key, F.col(id_).alias("i"), F.col(x).alias("x"), F.col(y).alias("y")).where("x = x and y = y and not isnan(x) and not isnan(y)")
    each = p.withColumn("line", F.explode(F.sequence(F.lit(0), F.lit(tries - 1))))
    drawn = lambda k: F.xxhash64("i", "line", F.lit(seed), F.lit(k))
    first = each.groupBy(key, "line").agg(F.min_by("x", drawn(1)).alias("x1"), F.min_by("y", drawn(1)).alias("y1"))
    dx, dy = F.col("x") - F.col("x1"), F.col("y") - F.col("y1")
    far = p.join(small(first), key).where(dx * dx + dy * dy >= apart * apart)
    pair = far.groupBy(key, "line").agg(F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.min_by("x", drawn(2)).alias("x2"), F.min_by("y", drawn(2)).alias("y2"))
    angle = F.atan2(F.col("y2") - F.col("y1"), F.col("x2") - F.col("x1"))
    lines = pair.select(key, "line", angle.alias("angle"), "x1", "y1").withColumn("offset", F.cos("angle") * F.col("y1") - F.sin("angle") * F.col("x1")).drop("x1", "y1")
    near = F.abs(F.cos("angle") * F.col("y") - F.sin("angle") * F.col("x") - F.col("offset")) <= threshold
    score = p.join(small(lines), key).groupBy(key, "line").agg(F.min("angle").alias("angle"), F.min("offset").alias("offset"), F.count_if(near).alias("inliers"))
    best = score.groupBy(key).agg(F.max(F.struct("inliers", (-F.col("line")).alias("l"), "angle", "offset")).alias("m"))
    return best.select(key, (-F.col("m.l")).alias("line"), F.col("m.angle").alias("angle"), F.col("m.offset").alias("offset"), F.col("m.inliers").alias("inliers"))


def tls_planes(df: DataFrame, key: str) -> DataFrame:
    """(key, n, nx, ny, nz, offset, rms) of points (x, y, z): moments by Spark, one 3x3 problem per key in numpy."""
    pairs = ["xx", "yy", "zz", "xy", "xz", "yz"]
    m = df.groupBy(key).agg(F.count("*").alias("n"), *[F.avg(c).alias(f"m{c}") for c in "xyz"], *[F.covar_pop(a, b).alias(f"s{a}{b}") for a, b in pairs])

    def solve(batches):
        for g in batches:
            out = []
            for r in g.itertuples(index=False):
                c = np.array([[r.sxx, r.sxy, r.sxz], [r.sxy, r.syy, r.syz], [r.sxz, r.syz, r.szz]])
                values, vectors = np.linalg.eigh(c)
                v = vectors[:, 0]
                k = int(np.argmax(np.abs(v)))
                v = v if v[k] > 0 else -v
                out.append((getattr(r, key), r.n, *v, float(v @ [r.mx, r.my, r.mz]), float(np.sqrt(max(0.0, values[0])))))
            yield pd.DataFrame(out, columns=[key, "n", "nx", "ny", "nz", "offset", "rms"])

    return m.mapInPandas(solve, f"{key} {dict(df.dtypes)[key]}, n long, nx double, ny double, nz double, offset double, rms double")


def scale_shift(df: DataFrame, key: str, x: str, y: str, least: int = 100, low: float = 0.1, high: float = 10.0) -> DataFrame:
    """(key, n, scale, shift, rms): repeated-median fits of y = scale * x + shift per frame.

    The slope is the median over points of each one's median slope to the others, the shift
    the median of y - scale * x. A key with fewer than `least` points or an implausible scale has none.
    """

    def fit(g: pd.DataFrame) -> pd.DataFrame:
        a, b = g[x].to_numpy(float), g[y].to_numpy(float)
        ok = np.isfinite(a) & np.isfinite(b)
        a, b = a[ok], b[ok]
        none = pd.DataFrame([(g[key].iloc[0], len(a), None, None, None)], columns=[key, "n", "scale", "shift", "rms"]).astype({"scale": float, "shift": float, "rms": float})
        if len(a) < least:
            return none
        with np.errstate(divide="ignore", invalid="ignore"):
            slopes = [np.nanmedian(np.where(a != p, (b - q) / (a - p), np.nan)) for p, q in zip(a, b, strict=True)]
            scale = float(np.nanmedian(slopes))
        shift = float(np.median(b - scale * a))
        if not low <= scale <= high:
            return none
        return pd.DataFrame([(g[key].iloc[0], len(a), scale, shift, float(np.sqrt(np.mean((scale * a + shift - b) ** 2))))], columns=[key, "n", "scale", "shift", "rms"])

    return df.select(key, x, y).groupBy(key).applyInPandas(fit, f"{key} {dict(df.dtypes)[key]}, n long, scale double, shift double, rms double")


def similarity(source: np.ndarray, target: np.ndarray, with_scale: bool) -> tuple[float, np.ndarray, np.ndarray]:
    """(scale, rotation, shift) that best takes source points to target points."""
    ms, mt = source.mean(0), target.mean(0)
    a, b = source - ms, target - mt
    u, d, vt = np.linalg.svd(b.T @ a / len(a))
    sign = np.diag([1.0, 1.0, np.sign(np.linalg.det(u @ vt)) or 1.0])
    r = u @ sign @ vt
    scale = float((d * np.diag(sign)).sum() / (a**2).sum() * len(a)) if with_scale else 1.0
    return scale, r, mt - scale * r @ ms
