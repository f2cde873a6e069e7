"""Which depth a frame is rebuilt from, and what of its pixels counts.

frames(index, pose, ts, approved, dense_error, dense_reason, dense_provenance, has_raw) has a row for
each requested frame: approved is null where the manifest has no entry, dense_error says why an
approved raster cannot be used (null: it can).  Every frame ends as one of `dense`, `raw` or
`rejected`, with its reason and, where raw depth stands in, why.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names and texts must equal those that reports are held against.
DENSE = "metric3d_v2_scale_shift_lidar_residual"
RAW = "raw_lidar"
MODES = ("auto", "raw", "dense")


def frame_indices(frames: DataFrame, index: str = "index") -> DataFrame:
    """The distinct indices of 0 and more, sorted."""
    return frames.where(F.col(index) >= 0).select(index).distinct().orderBy(index)


def strided(frames: DataFrame, key: str, index: str, stride: int) -> DataFrame:
    """Every stride-th row of each key by index, from the first; a stride below 1 is an error."""
    from pyspark.sql import Window

    if isinstance(stride, bool) or int(stride) != stride or stride < 1:
        raise ValueError(f"a stride must be a whole number of 1 or more, not {stride!r}")
    place = F.row_number().over(Window.partitionBy(key).orderBy(index)) - 1
    return frames.withColumn("__place", place).where(F.pmod("__place", F.lit(int(stride))) == 0).drop("__place")


def determinant(pose: Column) -> Column:
    m = [[pose[4 * i + j] for j in range(3)] for i in range(3)]
    return m[0][0] * (m[1][1] * m[2][2] - m[1][2] * m[2][1]) - m[0][1] * (m[1][0] * m[2][2] - m[1][2] * m[2][0]) + m[0][2] * (m[1][0] * m[2][1] - m[1][1] * m[2][0])


def decide(frames: DataFrame, mode: str = "auto", dense_dir: bool = False) -> DataFrame:
    """frames with decision, reason, source and fallback (why raw depth stands in, else null)."""
    if mode not in MODES:
        raise ValueError(f"no such depth mode: {mode}")
    pose, raw = F.col("pose"), F.coalesce("has_raw", F.lit(False))
    missing = pose.isNull() | F.col("ts").isNull()
    bad = (F.size(pose) != 16) | F.exists(pose, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    singular = F.abs(determinant(pose)) < 1e-8
    listed, fine = F.col("approved").isNotNull(), F.coalesce("approved", F.lit(False)) & F.col("dense_error").isNull()
    # why the dense raster is not used, null where there is nothing to say
    unlisted = "dense raster has no QC-approved manifest entry" if dense_dir else None
    why = F.when(F.coalesce("approved", F.lit(False)), F.col("dense_error")).when(listed, F.when(F.coalesce("dense_reason", F.lit("")) == "", "manifest entry is not qc_approved").otherwise(F.col("dense_reason"))).otherwise(F.lit(unlisted))
    broken = F.coalesce("approved", F.lit(False))
    as_fallback = F.concat(F.when(broken, F.concat(F.lit("dense frame rejected ("), why, F.lit(")"))).otherwise(why), F.lit("; raw LiDAR used"))
    as_reason = F.when(broken, F.concat(F.lit("dense frame rejected: "), why)).otherwise(why)
    provenance = F.coalesce("dense_provenance", F.lit(DENSE))
    if mode == "raw":
        dense, stands_in, refused = F.lit(False), F.lit(False), F.lit(False)
    else:
        dense = fine
        stands_in = ~fine & why.isNotNull() & raw if mode == "auto" else F.lit(False)
        refused = ~fine & why.isNotNull() & ~stands_in
    none = F.when(~raw, F.lit("raw LiDAR source was requested but no raw LiDAR depth is available" if mode == "raw" else "no QC-approved dense depth and no raw LiDAR depth"))
    nothing = F.lit("dense depth source was requested but no QC-approved entry exists") if mode == "dense" else none
    reason = (
        F.when(missing, "pose/timestamp table has no matching frame").when(bad, "pose is not a finite 4x4 transform").when(singular, "pose rotation/linear part is singular")
        .when(dense, F.lit(None)).when(refused, as_reason).when(stands_in, none).otherwise(nothing)
    )
    pose_fault = missing | bad | singular
    source = F.when(missing, "unknown").when(pose_fault, "pose").when(dense | refused, provenance).when(F.lit(mode == "dense"), DENSE).otherwise(RAW)
    x = frames.withColumn("reason", reason).withColumn("source", source)
    x = x.withColumn("fallback", F.when(~pose_fault & stands_in, as_fallback))
    return x.withColumn("decision", F.when(F.col("reason").isNotNull(), "rejected").when(F.coalesce(dense, F.lit(False)), "dense").otherwise("raw"))


def raw_pixel(depth_mm: Column, confidence: Column, least: int = 1, most: float = 8.0) -> Column:
    """(depth, confidence, qc) of a raw pixel: metres, 0 unless it is valid; a missing confidence is 2."""
    depth = (depth_mm / 1000.0).cast("float")
    sure = F.coalesce(confidence, F.lit(2))
    qc = F.coalesce((depth > 0) & (depth <= most), F.lit(False))
    return F.struct(F.when(qc & (sure >= least), depth).otherwise(F.lit(0.0).cast("float")).alias("depth"), sure.alias("confidence"), qc.alias("qc"))


def dense_pixel(depth: Column, confidence: Column, mask: Column, least: int = 1, most: float = 8.0) -> Column:
    """(depth, confidence, qc) of a dense pixel: its mask must be set, its confidence high enough, its depth in range."""
    sure = F.coalesce(confidence, F.lit(2))
    qc = F.coalesce((mask > 0) & ~F.isnan(depth) & (depth > 0) & (depth <= most) & (sure >= least), F.lit(False))
    return F.struct(F.when(qc, depth.cast("float")).otherwise(F.lit(0.0).cast("float")).alias("depth"), sure.alias("confidence"), qc.alias("qc"))


def valid_pixel(p: Column) -> Column:
    """Whether a pixel (depth, confidence, qc) can be used."""
    return F.coalesce(p["qc"] & (p["confidence"] >= 0) & ~F.isnan(p["depth"]) & (F.abs(p["depth"]) < float("inf")) & (p["depth"] > 0), F.lit(False))


def lidar_valid(depth: Column, confidence: Column, least: int, most: float) -> Column:
    return F.coalesce((confidence >= least) & (depth > 0) & (depth <= most), F.lit(False))


def iter_pixel(depth_mm: Column, confidence: Column, least: int = 1, most: float = 8.0) -> Column:
    """A raster's depth in metres, 0 where it is too uncertain or too far."""
    depth = depth_mm / 1000.0
    return F.when((F.coalesce(confidence, F.lit(2)) < least) | (depth > most), 0.0).otherwise(depth)


def contract_report(decided: DataFrame, by: str = "capture") -> DataFrame:
    """(by, counters and sorted lists): a row per capture on what became of its frames.

    decided is what `decide` gives with the capture's column; lists hold frame numbers of one capture.
    """
    is_ = lambda d: F.col("decision") == d
    listed = F.col("approved").isNotNull()
    events = F.array_sort(F.collect_list(F.when(is_("rejected"), F.struct("index", "reason", "source"))))
    stand_ins = F.array_sort(F.collect_list(F.when(F.col("fallback").isNotNull(), F.struct("index", F.col("fallback").alias("reason")))))
    out = decided.groupBy(by).agg(
        F.count_distinct("index").alias("selected_frames"),
        F.count_if(listed).alias("densified_frames"),
        F.count_if(F.coalesce("approved", F.lit(False))).alias("qc_approved_dense_frames"),
        F.count_if(is_("dense") | is_("raw")).alias("fused_frames"),
        F.count_if(is_("dense")).alias("fused_dense_frames"),
        F.count_if(is_("raw")).alias("fused_raw_frames"),
        F.count_if(is_("rejected")).alias("rejected_frames"),
        F.count_if(listed & ~F.coalesce("approved", F.lit(False))).alias("dense_qc_rejected_frames"),
        F.count_if(F.col("fallback").isNotNull()).alias("fallback_frames"),
        F.array_sort(F.collect_set(F.when(~is_("rejected"), F.col("source")))).alias("depth_sources"),
        F.array_sort(F.collect_list(F.when(~is_("rejected"), F.col("index")))).alias("integrated_indices"),
        events.alias("rejections"),
        stand_ins.alias("fallbacks"),
    )
    return out.withColumn("rejected_frames_total", F.col("rejected_frames") + F.col("dense_qc_rejected_frames"))


def missing_frames(requested: DataFrame, delivered: DataFrame, by: list[str]) -> DataFrame:
    """requested(by) that the stream never delivered, each with the reason that reports give."""
    return requested.join(delivered.select(*by).distinct(), by, "left_anti").withColumn("reason", F.lit("requested frame was not delivered"))


def densify_gate(pixels: DataFrame, by: list[str], valid: Column, error: Column, coverage: float = 0.25, rms: float = 0.25) -> DataFrame:
    """(by, coverage, rms, approved): a densified frame is good if enough of it is valid and its residual is small."""
    share = F.avg(F.coalesce(valid, F.lit(False)).cast("double"))
    residual = F.sqrt(F.avg(F.when(valid, error * error)))
    x = pixels.groupBy(*by).agg(share.alias("coverage"), residual.alias("rms"))
    return x.withColumn("approved", (F.col("coverage") >= coverage) & F.coalesce(F.col("rms") <= rms, F.lit(False)))
