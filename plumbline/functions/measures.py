"""Uncertainty of measurements: half-widths, confidences, flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geometry import clip

#: Fixed values of the model: coverage factor, least plane sigma in metres, without-depth factor.
Z, LEAST_SIGMA, NO_DEPTH = 1.645, 0.002, 3.0


def plane_sigma(rms: Column, n: Column, drift: Column | float = 0.0) -> Column:
    """Uncertainty of a plane's offset from its residuals, points and drift."""
    drift = drift if isinstance(drift, Column) else F.lit(float(drift))
    return F.sqrt(F.pow(F.greatest(rms / F.sqrt(F.greatest(n, F.lit(1))), F.lit(LEAST_SIGMA)), 2) + drift * drift)


def _modality(depth: Column | bool, no_depth: float) -> Column:
    """1 with depth, else the factor that measuring without it costs."""
    return F.when(depth if isinstance(depth, Column) else F.lit(depth), 1.0).otherwise(no_depth)


def length_half_width(rms: Column, n: Column, drift: Column, inferred: Column, depth: Column | bool = True, scale: float = 1.0, no_depth: float = NO_DEPTH) -> Column:
    """Half-width of a wall's length: both ends, more for what was inferred.

    `scale` is a learned calibration, `no_depth` what measuring without depth costs; both hold for
    heights and areas too.
    """
    return Z * 2 * plane_sigma(rms, n, drift) * (1 + 1.5 * F.greatest(inferred, F.lit(0.0))) * scale * _modality(depth, no_depth)


def height_half_width(rms1: Column, n1: Column, rms2: Column, n2: Column, depth: Column | bool = True, scale: float = 1.0, no_depth: float = NO_DEPTH) -> Column:
    return Z * F.hypot(plane_sigma(rms1, n1), plane_sigma(rms2, n2)) * scale * _modality(depth, no_depth)


def area_half_width(perimeter: Column, sigma: Column, depth: Column | bool = True, scale: float = 1.0, no_depth: float = NO_DEPTH) -> Column:
    return perimeter * sigma / 2 * Z * scale * _modality(depth, no_depth)


def damage_half_width(area: Column, views: Column, trusted: Column, scale: float = 1.0) -> Column:
    """Half-width of a damaged area; outlines that are boxes add a quarter, missing depth nothing."""
    return area * (0.12 / F.sqrt(F.greatest(views, F.lit(1))) + F.when(trusted, 0.0).otherwise(0.25)) * Z * scale


def evidence_confidence(views: Column, weight: Column, model: Column) -> Column:
    """Confidence of a region from its views, weight and the model's own figure."""
    agreement = 1 - F.exp(-0.55 * F.greatest(views - 1, F.lit(0)))
    return clip(0.5 * agreement + 0.25 * clip(weight / 3, 0.0, 1.0) + 0.25 * model, 0.0, 1.0)


def flags(*rules: tuple[Column, str]) -> Column:
    """Sorted distinct names of the rules that hold."""
    return F.array_sort(F.array_distinct(F.filter(F.array(*[F.when(c, F.lit(n)) for c, n in rules]), lambda x: x.isNotNull())))


#: Coverage factors; another coverage takes the one of 0.90.
Z_SCORES = {0.68: 1.0, 0.80: 1.282, 0.90: 1.645, 0.95: 1.96}
CALIBRATED = ("calibrated", "validated")
RAW_POSES = ("unknown", "raw", "unrefined", "none")
WEAK_DEPTH = ("unknown", "estimated_depth", "video_only", "monocular")


def opening_half_width(resolution: Column, confidence: Column, sigma: Column, depth: Column, scale: float = 1.0, no_depth: float = NO_DEPTH) -> Column:
    """Half-width of an opening: grid step, the source's own sigma and what its confidence lacks."""
    s = F.hypot(F.hypot(resolution / F.sqrt(F.lit(12.0)) * 2, F.greatest(sigma, F.lit(0.0))), 0.03 * (1 - confidence))
    return Z * s * scale * F.when(depth, 1.0).otherwise(no_depth)


def interval(value: Column, half: Column, coverage: float = 0.9) -> Column:
    """(value, ci_low, ci_high, half_width, coverage), to four places."""
    return F.struct(F.round(value, 4).alias("value"), F.round(value - half, 4).alias("ci_low"), F.round(value + half, 4).alias("ci_high"), F.round(half, 4).alias("half_width"), F.lit(coverage).alias("coverage"))


def evidence_score(e: Column) -> Column:
    """Confidence in [0, 1] of evidence (rms, points, density, pose, depth, calibration, pose_sigma)."""
    named = lambda x, words: F.coalesce(x.rlike("|".join(words)), F.lit(False))
    blank = lambda x: F.coalesce(x.isin("unknown", "none", ""), F.lit(True))
    support = F.least(F.lit(1.0), F.sqrt(F.greatest(e["points"], F.lit(0))) / F.sqrt(F.lit(500.0)))
    density = F.coalesce(F.least(F.lit(1.0), e["density"] / 80.0), F.lit(0.65))
    pose = F.when(blank(e["pose"]), 0.55).when(named(e["pose"], ("refined", "optimized", "slam")), 0.95).otherwise(0.7)
    depth = F.when(blank(e["depth"]), 0.6).when(named(e["depth"], ("lidar", "tls", "laser", "measured")), 0.95).otherwise(0.5)
    known = F.when(e["calibration"].isin(*CALIBRATED), 1.0).otherwise(0.78)
    total = 0.28 * support + 0.18 * density + 0.24 * F.exp(-e["rms"] / 0.045) + 0.09 * pose + 0.03 * F.exp(-e["pose_sigma"] / 0.05) + 0.10 * depth + 0.08 * known
    return clip(total, 0.0, 1.0)


def measurement_flags(e: Column, confidence: Column, inferred: Column | bool = False, assumed: Column | bool = False) -> Column:
    """What a reader should know of a measurement: sorted names of the rules that hold."""
    as_column = lambda x: x if isinstance(x, Column) else F.lit(x)
    return flags(
        (e["points"] < 100, "weak_support"),
        (e["density"] < 20, "weak_support_density"),
        (e["rms"] > 0.04, "high_tls_residual"),
        (e["pose_sigma"] > 0.05, "high_pose_uncertainty"),
        (e["pose"].isin(*RAW_POSES), "pose_uncertain"),
        (e["depth"].isin(*WEAK_DEPTH), "depth_uncertain"),
        (~e["calibration"].isin(*CALIBRATED), "uncalibrated"),
        (as_column(inferred), "inferred_geometry"),
        (as_column(assumed), "assumed_wall_thickness"),
        (confidence < 0.6, "manual_review"),
    )


def measurement(value: Column, e: Column, basis: str, sigma: Column | None = None, inferred: Column | bool = False, assumed: Column | bool = False, coverage: float = 0.9, scale: float = 1.0) -> Column:
    """(value, tolerance, confidence, status, basis, flags): a measured value with its evidence's half-width."""
    confidence = evidence_score(e)
    own = e["rms"] / F.greatest(F.sqrt(e["points"]), F.lit(1.0))
    s = F.greatest(F.coalesce(sigma, own) if sigma is not None else own, F.lit(LEAST_SIGMA))
    s = F.hypot(s, e["pose_sigma"])
    s = s * F.when(e["density"] < 80, 1 + F.least(F.lit(1.5), (80 - e["density"]) / 80)).otherwise(1.0)
    s = s * F.when(e["pose"].isin(*RAW_POSES), 1.25).otherwise(1.0) * F.when(e["depth"].isin(*WEAK_DEPTH), 3.0).otherwise(1.0)
    s = s * scale * F.when(e["calibration"].isin(*CALIBRATED), 1.0).otherwise(1.1)
    z = Z_SCORES.get(round(coverage, 2), Z)
    return F.struct(value.alias("value"), (z * s).alias("tolerance"), confidence.alias("confidence"), F.lit("measured").alias("status"), F.lit(basis).alias("basis"), measurement_flags(e, confidence, inferred, assumed).alias("flags"))


def unmeasured(basis: str, *names: str) -> Column:
    """The record of what could not be measured."""
    none = F.lit(None).cast("double")
    return F.struct(none.alias("value"), none.alias("tolerance"), F.lit(0.0).alias("confidence"), F.lit("unmeasured").alias("status"), F.lit(basis).alias("basis"), F.array(*[F.lit(n) for n in (*names, "manual_review")]).alias("flags"))


def combined_evidence() -> list[Column]:
    """Aggregates over rows of evidence: root mean square residual, all points, mean density, largest pose sigma."""
    return [F.sqrt(F.avg(F.col("rms") * F.col("rms"))).alias("rms"), F.sum("points").alias("points"), F.avg("density").alias("density"), F.max("pose_sigma").alias("pose_sigma")]


def scale_validation(observed: Column, known: Column, kind: Column, tolerance: Column) -> Column:
    """(kind, factor, tolerance, confidence, status): a known length against an observed one, never applied by itself.

    A door is only ever advice; lengths that are not positive measure nothing.
    """
    from .records import finite, status

    k = F.replace(status(kind), F.lit("-"), F.lit("_"))
    k = F.when(k.isin("user_supplied", "user_reference", "known_reference"), "user").otherwise(k)
    o, t = finite(observed), finite(known)
    ok = F.coalesce((o > 0) & (t > 0), F.lit(False)) & (k != "door")
    factor = F.when(ok, t / o)
    width = F.when(ok, F.greatest(F.coalesce(finite(tolerance), 0.01 * t), F.lit(0.001)))
    sure = F.greatest(clip(1 - F.abs(o * factor - t) / F.greatest(width, F.lit(1e-9)), 0.0, 1.0), F.lit(0.9))
    state = F.when(k == "door", "advisory").when(ok, "validated").otherwise("unmeasured")
    return F.struct(k.alias("kind"), factor.alias("factor"), width.alias("tolerance"), F.when(k == "door", 0.2).when(ok, sure).otherwise(0.0).alias("confidence"), state.alias("status"))


def plane_fit(height: Column, n: Column, rms: Column, quality: Column, sigma: Column, least: int, total: Column, limit: float = 0.04) -> Column:
    """(height, confidence, status, support, adaptive_limit, reasons) of a candidate plane at a height."""
    base = clip(0.45 * F.least(F.lit(1.0), n / max(least, 1)) + 0.35 * F.exp(-rms / max(limit, 1e-9)) + 0.2 * clip(quality, 0.0, 1.0), 0.0, 1.0)
    wide = clip(F.greatest(F.lit(limit), 2.5 * sigma + 0.01), limit, max(3 * limit, 0.12))
    supported, good, strict, loose = n >= max(least, 1), quality >= 0.35, rms <= limit, rms <= wide
    high, seen = strict & supported & good, supported & (n > 0)
    state = F.when(high, "high_confidence").when(seen, "low_confidence").otherwise("rejected")
    confidence = F.when(high, base).when(seen, F.when(loose & good, 0.65).otherwise(0.35) * base).otherwise(0.0)
    why = ((~supported, "support_below_threshold"), (~good, "candidate_quality_below_threshold"), (~strict, "residual_above_strict_threshold"), (~loose, "residual_above_adaptive_threshold"))
    reasons = F.filter(F.array(*[F.when(c, F.lit(w)) for c, w in why]), lambda x: x.isNotNull())
    return F.struct(F.when(seen, height).alias("height"), confidence.alias("confidence"), state.alias("status"), clip(n / F.greatest(total, F.lit(1)), 0.0, 1.0).alias("support"), wide.alias("adaptive_limit"), reasons.alias("reasons"))


def refinement_accepted(correction: Column, limit: Column, loops: Column, before: Column, after: Column, loop_before: Column, loop_after: Column, gap_before: Column, gap_after: Column) -> Column:
    """Reasons against a refined trajectory, in order; none means that it is accepted."""
    lost = loop_before.isNull() | loop_after.isNull()
    why = (
        (correction > limit, F.format_string("maximum correction %.3f m exceeds %.3f m", correction, limit)),
        (loops == 0, F.lit("no loop-closure edge was accepted; retaining raw ARKit poses")),
        (after >= before - 1e-6, F.format_string("pose-graph objective did not improve (%.6f -> %.6f)", before, after)),
        (lost, F.lit("loop residual is unavailable; retaining raw ARKit poses")),
        (~lost & (loop_after >= loop_before - 1e-4), F.format_string("loop residual did not improve (%.4f -> %.4f)", loop_before, loop_after)),
        (gap_after > gap_before + 0.05, F.format_string("loop closure gap worsened (%.3f m -> %.3f m)", gap_before, gap_after)),
    )
    return F.filter(F.array(*[F.when(c, w) for c, w in why]), lambda x: x.isNotNull())
