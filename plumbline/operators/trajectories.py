"""Trajectories: clocks matched, one laid onto another, corrections of keyframes spread over all frames."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import poses
from ..functions.geometry import quaternion_matrix
from .asof import bracket, nearest
from .fits import similarity


def clock_matches(trajectory: DataFrame, priors: DataFrame, key: str, tolerance: float) -> DataFrame:
    """(key, ts, prior_ts, error, offset): a trajectory's times with the priors' under the clock offset that fits best.

    Offsets tried are 0 and those that lay the first or the last times onto each other.  Under each a
    time takes its nearest prior within the tolerance, the earlier of two equally near; a prior goes
    to the first time that claims it.  The offset with most matches wins, then the smaller median
    error, then the smaller offset.  Rows are matched in one sort per offset, no pairs are made.
    """
    ends = lambda df, n: df.groupBy(key).agg(F.min("ts").alias(f"{n}0"), F.max("ts").alias(f"{n}1"))
    offsets = ends(trajectory, "a").join(ends(priors, "b"), key)
    offsets = offsets.select(key, F.explode(F.array_distinct(F.array(F.lit(0.0), F.col("b0") - F.col("a0"), F.col("b1") - F.col("a1")))).alias("offset"))
    tried = F.struct(key, "offset").alias("__k")
    left = trajectory.select(key, "ts").join(offsets, key).select(tried, (F.col("ts") + F.col("offset")).alias("t"), F.col("ts").alias("id"))
    right = priors.select(key, "ts").join(offsets, key).select(tried, F.col("ts").alias("t"), F.col("ts").alias("id"), F.lit(0).alias("value"))
    near = nearest(left, right, "__k", "t", "id", "value", "earlier", tolerance)
    first = F.row_number().over(Window.partitionBy("__k", "match_t").orderBy("id")) == 1
    x = near.withColumn("first", first).where("first").select("__k", F.col("id").alias("ts"), F.col("match_t").alias("prior_ts"), F.abs(F.col("match_t") - F.col("t")).alias("error"))
    score = x.groupBy("__k").agg(F.count("*").alias("n"), F.median("error").alias("m"))
    best = score.groupBy(F.col(f"__k.{key}").alias(key)).agg(F.max_by("__k", F.struct("n", -F.col("m"), -F.abs("__k.offset"))).alias("__k"))
    return x.join(best.select("__k"), "__k").select(F.col(f"__k.{key}").alias(key), "ts", "prior_ts", "error", F.col("__k.offset").alias("offset"))


def align(pairs: DataFrame, key: str, mode: str = "auto", rmse: float = 0.15, largest: float = 0.5, least: int = 3) -> DataFrame:
    """(key, mode, scale, rotation, translation, n, inliers, rmse, largest, failures): one trajectory's places laid onto another's.

    pairs(key, sx, sy, sz, tx, ty, tz).  One pass drops pairs whose error is above 0.03 and above the median
    by three scaled median deviations.  `auto` is rigid if the scale is within 0.02 of 1.  A key's
    matched places are one task's group: a row for each frame of one capture.
    """

    def fit(g: pd.DataFrame) -> pd.DataFrame:
        name = g[key].iloc[0]
        a, b = g[["sx", "sy", "sz"]].to_numpy(float), g[["tx", "ty", "tz"]].to_numpy(float)
        if len(a) < least:
            return pd.DataFrame([(name, mode, None, None, None, len(a), 0, None, None, ["too few matched places"])])

        def robust(with_scale: bool) -> tuple:
            s, r, t = similarity(a, b, with_scale)
            err = np.linalg.norm(s * a @ r.T + t - b, axis=1)
            mid = np.median(err)
            keep = err <= max(0.03, mid + 3 * 1.4826 * np.median(np.abs(err - mid)))
            if least <= keep.sum() < len(a):
                s, r, t = similarity(a[keep], b[keep], with_scale)
            return s, r, t, keep

        used = mode
        s, r, t, keep = robust(mode != "se3")
        if mode == "auto":
            used = "se3" if abs(s - 1) <= 0.02 else "sim3"
            if used == "se3":
                s, r, t, keep = robust(False)
        err = np.linalg.norm(s * a[keep] @ r.T + t - b[keep], axis=1)
        root, top = float(np.sqrt(np.mean(err**2))), float(err.max())
        wrong = [w for w, bad in ((f"rmse {root:.3f} m exceeds {rmse:.3f} m", root > rmse), (f"largest error {top:.3f} m exceeds {largest:.3f} m", top > largest)) if bad]
        return pd.DataFrame([(name, used, float(s), r.ravel().tolist(), t.tolist(), len(a), int(keep.sum()), root, top, wrong)])

    kind = dict(pairs.dtypes)[key]
    out = f"{key} {kind}, mode string, scale double, rotation array<double>, translation array<double>, n long, inliers long, rmse double, largest double, failures array<string>"
    named = lambda g: fit(g).set_axis([c.split()[0] for c in out.split(", ")], axis=1)
    return pairs.groupBy(key).applyInPandas(named, out)


def resample_poses(targets: DataFrame, samples: DataFrame, key: str, gap: float = 1.0) -> DataFrame:
    """(key, ts, quaternion, place): a trajectory at other times, turned along arcs and moved along lines.

    samples(key, ts, quaternion, place).  A target outside the samples, or in a step of more than gap
    seconds, is an error; one within 1e-8 of a sample is that sample.
    """
    left = targets.select(key, F.col("ts").alias("t"), F.lit(0).alias("id"))
    right = samples.select(key, F.col("ts").alias("t"), F.lit(0).alias("id"), F.struct("quaternion", "place").alias("value"))
    x = bracket(left, right, key, "t", "id", "value")
    a, b, t = F.col("before"), F.col("after"), F.col("t")
    at_a, at_b = F.coalesce(F.abs(t - a["t"]) <= 1e-8, F.lit(False)), F.coalesce(F.abs(t - b["t"]) <= 1e-8, F.lit(False))
    share = (t - a["t"]) / (b["t"] - a["t"])
    outside = F.format_string("time %s lies outside the trajectory", t.cast("string"))
    wide = F.format_string("time %s lies in a step of more than %s s", t.cast("string"), F.lit(str(gap)))
    kind = "struct<quaternion:array<double>,place:array<double>>"
    between = F.struct(poses.slerp_any(a["value"]["quaternion"], b["value"]["quaternion"], share).alias("quaternion"), F.zip_with(a["value"]["place"], b["value"]["place"], lambda p, q: p + share * (q - p)).alias("place"))
    got = F.when(at_a, a["value"]).when(at_b, b["value"]).when(a.isNull() | b.isNull(), F.raise_error(outside).cast(kind)).when(b["t"] - a["t"] > gap, F.raise_error(wide).cast(kind)).otherwise(between)
    return x.select(key, F.col("t").alias("ts"), got.alias("g")).select(key, "ts", "g.quaternion", "g.place")


def _times(a: Column, b: Column) -> Column:
    """The product of two 4x4 poses."""
    row = lambda i, j: sum((a[4 * i + k] * b[4 * k + j] for k in range(4)), F.lit(0.0))
    return F.array(*[row(i, j) for i in range(4) for j in range(4)])


def inverse(pose: Column) -> Column:
    """The inverse of a rigid pose."""
    r, p = poses.rotation_of(pose), poses.place_of(pose)
    shift = [-(r[i] * p[0] + r[3 + i] * p[1] + r[6 + i] * p[2]) for i in range(3)]
    return F.array(*[c for i in range(3) for c in (r[i], r[3 + i], r[6 + i], shift[i])], *[F.lit(v) for v in (0.0, 0.0, 0.0, 1.0)])


def propagate(frames: DataFrame, keyframes: DataFrame, key: str) -> DataFrame:
    """(key, index, pose): every frame moved by the correction between its keyframes, the last one's held to the end.

    frames(key, index, pose), keyframes(key, index, refined).  A correction is blended by index, its
    rotation along an arc and its place along a line; frames before the first keyframe stay.
    """
    x = frames.join(keyframes, [key, "index"], "left")
    fix = _times(F.col("refined"), inverse(F.col("pose")))
    x = x.withColumn("fix", F.when(F.col("refined").isNotNull(), fix))
    turn = poses.matrix_quaternion(F.array(*poses.rotation_of(F.col("fix"))))
    x = x.withColumn("c", F.when(F.col("fix").isNotNull(), F.struct("index", turn.alias("q"), F.array(*poses.place_of(F.col("fix"))).alias("p"))))
    order = Window.partitionBy(key).orderBy("index")
    x = x.withColumn("a", F.last("c", True).over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("b", F.first("c", True).over(order.rowsBetween(1, Window.unboundedFollowing)))
    share = (F.col("index") - F.col("a.index")) / F.greatest(F.col("b.index") - F.col("a.index"), F.lit(1))
    last = F.col("b").isNull()
    x = x.withColumn("q", F.when(last, F.col("a.q")).otherwise(poses.slerp(F.col("a.q"), F.col("b.q"), share))).withColumn("p", F.when(last, F.col("a.p")).otherwise(F.zip_with("a.p", "b.p", lambda p, q: p * (1 - share) + q * share)))
    x = x.withColumn("m", quaternion_matrix(*[F.col("q")[i] for i in range(4)]))
    rows = [c for i in range(3) for c in (*[F.col("m")[3 * i + j] for j in range(3)], F.col("p")[i])]
    moved = _times(F.array(*rows, *[F.lit(v) for v in (0.0, 0.0, 0.0, 1.0)]), F.col("pose"))
    return x.select(key, "index", F.when(F.col("a").isNull(), F.col("pose")).otherwise(moved).alias("pose"))
