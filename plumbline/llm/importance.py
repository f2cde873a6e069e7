"""Importance resampling with hashed n-gram models of target and raw text.

Both texts are bags of hashed word unigrams and bigrams.  A document's log importance weight
is the sum of ln p_target - ln p_raw over its n-grams; adding Gumbel noise and taking the k
largest draws k documents without replacement, with chances by weight.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textarrays as ta
from .storage import stored

BUCKETS = 10_000
#: Target ids may be broadcast up to this many.
BROADCAST_IDS = 1_000_000
#: Keys that the driver sorts at the end of the search for the k-th.
SORTED = 4096


def features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, document) of every unigram and bigram of lower-cased words."""
    data = ta.LOWER[data]
    starts, ends, doc = ta.words(data, offs)
    one = ta.span_hash(data, starts, ends, 31)
    two = ta.window_hash(one, 2, 31)
    same = doc[1:] == doc[:-1] if len(two) else np.zeros(0, bool)
    of = np.concatenate([doc, doc[:-1][same]]) if len(two) else doc
    return (np.concatenate([one, two[same]]) % np.uint64(BUCKETS)).astype(np.int64), of


def ngram_models(docs: DataFrame, target: DataFrame) -> np.ndarray:
    """ln p_target - ln p_raw of each bucket, add-one smoothed, from all texts of docs.

    target holds the doc_ids of the target's documents.  A task adds up its counts in arrays and
    hands on a row per bucket, so the shuffle and the driver get BUCKETS numbers a task at most.
    """
    ids = stored(target.select("doc_id").where("doc_id is not null").distinct().withColumn("is_target", F.lit(True)), "target")
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, aim = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for lo, hi, data, offs in ta.chunks(batch.column(0)):
                chosen = batch.column(1).slice(lo, hi - lo).fill_null(False).to_numpy(zero_copy_only=False)
                bucket, of = features(data, offs)
                raw += np.bincount(bucket, minlength=BUCKETS)
                aim += np.bincount(bucket[chosen[of]], minlength=BUCKETS)
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(aim[some])], names=["bucket", "raw", "target"])

    counts = docs.select("doc_id", "text").join(ids, "doc_id", "left").select("text", "is_target").mapInArrow(run, "bucket bigint, raw bigint, target bigint")
    raw, aim = np.ones(BUCKETS), np.ones(BUCKETS)
    for r in counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect():
        raw[r.bucket] += r.raw
        aim[r.bucket] += r.target
    return np.log(aim / aim.sum()) - np.log(raw / raw.sum())


def gumbel(doc_id: str = "doc_id", seed: int = 3):
    """Standard Gumbel noise from the seed and the doc_id alone."""
    unit = (F.pmod(F.xxhash64(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(doc_id).cast("string"), F.lit("null")))), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return -F.log(-F.log(unit))


def kth_largest(rows: DataFrame, k: int) -> tuple[float, int] | None:
    """(key, doc_id) of the k-th of rows(doc_id, key) by key descending, doc_id ascending.

    Narrows the key's range by counts in 1024 bins until few keys are left for the driver.
    """
    low, high, n = rows.agg(F.min("key"), F.max("key"), F.count("key")).first()
    if k <= 0 or not n:
        return None
    if k >= n:
        return float("-inf"), 2**63 - 1
    left, inside = k, n
    while inside > SORTED and low < high:
        width = (high - low) / 1024
        part = rows.where((F.col("key") >= low) & (F.col("key") <= high))
        place = F.least(F.floor((F.col("key") - low) / width), F.lit(1023)).alias("bin")
        bins = {r.bin: r for r in part.groupBy(place).agg(F.count("*").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi")).collect()}
        for b in sorted(bins, reverse=True):
            if bins[b].n >= left:
                low, high, inside = bins[b].lo, bins[b].hi, bins[b].n
                break
            left -= bins[b].n
    best = rows.where((F.col("key") >= low) & (F.col("key") <= high)).orderBy(F.desc("key"), "doc_id")
    if inside <= SORTED:
        r = best.collect()[left - 1]
        return r.key, r.doc_id
    # so many equal keys: the doc_id decides, by the same search over ids
    ids = rows.where(F.col("key") == low).select("doc_id", (-F.col("doc_id")).cast("double").alias("key"))
    return low, int(-kth_largest(ids, left)[0]) if ids.select("key").distinct().count() > 1 else ids.first().doc_id


def importance_resample(docs: DataFrame, target: DataFrame, fraction: float = 0.8, seed: int = 3) -> DataFrame:
    """(doc_id, n_grams, log_ratio, key, kept) of each row of docs(doc_id, text).

    Draws round(fraction * rows) documents by Gumbel top-k on key = log_ratio + noise; target
    names the documents that the draw should look like.  Null and empty texts have no n-grams
    and a ratio of 0.  Equal keys go by doc_id; rows that repeat a document share its noise and
    are kept or left together.  With an empty target all ratios are those of smoothing alone.
    """
    table = docs.sparkSession.sparkContext.broadcast(ngram_models(docs, target))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in ta.chunks(batch.column(1)):
                bucket, of = features(data, offs)
                n = np.bincount(of, minlength=hi - lo)
                total = np.bincount(of, weights=table.value[bucket], minlength=hi - lo)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(n), pa.array(total)], names=["doc_id", "n_grams", "log_ratio"])

    rows = docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n_grams bigint, log_ratio double")
    rows = stored(rows.withColumn("key", F.col("log_ratio") + gumbel("doc_id", seed)), "ratios")
    edge = kth_largest(rows, round(fraction * rows.count()))
    if edge is None:
        return rows.withColumn("kept", F.lit(False))
    key, last = edge
    return rows.withColumn("kept", (F.col("key") > key) | (F.col("key") == key) & (F.coalesce("doc_id", F.lit(-(2**63))) <= last))
