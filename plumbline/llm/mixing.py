"""Mixing sources to target weights by pivotal dependent rounding.

A document of a source with target T and size S is to be taken T / S times on average.  The
whole copies are taken; of the fractional ones, two at a time duel: words move from one
document to the other, in the direction that a fair draw picks, until a fraction is 0 or 1.
Expected copies and the source's words are kept by every duel.  Groups of documents of
similar size duel first; what is left of a group, one document with a fraction at most,
meets the rest of other groups in a reduction tree.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import textarrays as ta
from .storage import stored

#: Documents of a leaf group, about, and rests that one node of the tree combines.
LEAF, FAN = 5_000, 64


def word_sizes(docs: DataFrame, carry: tuple[str, ...] = ("doc_id", "source")) -> DataFrame:
    """The carried columns and `size`, the number of words; 0 for a null text."""
    import numpy as np
    import pyarrow as pa

    out = docs.select(*[docs[c] for c in carry], docs["text"].alias("__text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema.fields[:-1]] + ["size bigint"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in ta.chunks(batch.column(len(carry))):
                n = np.bincount(ta.words(data, offs)[2], minlength=hi - lo)
                yield pa.RecordBatch.from_arrays([*[batch.column(i).slice(lo, hi - lo) for i in range(len(carry))], pa.array(n)], names=[*carry, "size"])

    return out.mapInArrow(run, schema)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, n_docs, target) of each source, by code point, null last.

    Sources share `share` times all sizes by weight; a target stops at `most` times its source's
    size and the excess is reshared by weight until none is above.  The fixed point has a closed
    form: with sources in order of size / weight, those before some place are full and the rest
    get one rate.  Windows here are over one row per source, sums that documents were reduced to.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    x = total.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int")))
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(1))
    x = x.withColumn("place", F.row_number().over(order)).withColumn("budget", share * F.sum("source_size").over(every))
    x = x.withColumn("rate", (F.col("budget") - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    fits = F.col("rate") * F.col("weight") <= most * F.col("source_size")
    x = x.withColumn("first", F.min(F.when(fits, F.struct("place", "rate"))).over(every))
    target = F.when(F.col("place") >= F.col("first.place"), F.col("first.rate") * F.col("weight")).otherwise(most * F.col("source_size"))
    return x.select("source", "source_size", "n_docs", F.least(target, most * F.col("source_size")).cast("double").alias("target"))


def _draw(seed: int, *ids: object) -> float:
    """A uniform number in [0, 1) that depends on the seed and the ids alone."""
    h = hashlib.blake2b(repr((seed, *ids)).encode(), digest_size=8).digest()
    return int.from_bytes(h, "big") / 2**64


def duel(rows: pd.DataFrame, seed: int) -> pd.DataFrame:
    """Rounds the fractions `p` of rows(key, size, p) until at most one lies between 0 and 1.

    A document with a fraction meets the next smaller one.  If the first gained a and the
    second b words up to their whole copies, or lost c and d, then min(a, d) words move one way
    or min(b, c) the other, with chances that keep both expectations.
    """
    rows = rows.sort_values(["size", "key"], ascending=[False, True], kind="stable")
    keys, sizes, p = rows["key"].tolist(), rows["size"].tolist(), rows["p"].tolist()
    eps, held = 1e-9, None
    for i in range(len(p)):
        if not eps < p[i] < 1 - eps:
            p[i] = float(round(p[i]))
            continue
        if held is None:
            held = i
            continue
        h = held
        up = min((1 - p[h]) * sizes[h], p[i] * sizes[i])  # words from i to h
        down = min(p[h] * sizes[h], (1 - p[i]) * sizes[i])
        move = up if _draw(seed, keys[h], keys[i]) * (up + down) < down else -down
        p[h], p[i] = p[h] + move / sizes[h], p[i] - move / sizes[i]
        left = [j for j in (h, i) if eps < p[j] < 1 - eps]
        for j in (h, i):
            if j not in left:
                p[j] = float(round(p[j]))
        held = left[0] if left else None
    return rows.assign(p=p)


def mix_copies(sizes: DataFrame, targets: DataFrame, seed: int = 11) -> DataFrame:
    """(key, source, size, source_size, target, copies) from sizes(key, source, size).

    `key` must tell rows apart.  Documents without words are never taken.  The draws depend on
    seed and keys only, so reruns and other partitionings agree.
    """
    same = F.col("t.source").eqNullSafe(F.col("d.source"))
    rows = sizes.alias("d").join(F.broadcast(targets.alias("t")) if targets.count() <= 100_000 else targets.alias("t"), same)
    rows = rows.select("d.key", "d.source", "d.size", "t.source_size", "t.target", "t.n_docs")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = rows.withColumn("whole", F.when(F.col("size") > 0, F.floor(ratio + 1e-9)).otherwise(0).cast("int")).withColumn("p", F.when(F.col("size") > 0, F.greatest(F.lit(0.0), ratio - F.floor(ratio + 1e-9))).otherwise(0.0))
    groups = F.ceil(F.col("n_docs") / LEAF)
    rows = rows.withColumn("node", F.pmod(F.xxhash64("key"), groups).cast("long")).drop("n_docs")
    schema = "key string, source string, size bigint, p double, node bigint"

    def round_group(g: pd.DataFrame) -> pd.DataFrame:
        return duel(g, seed)[["key", "source", "size", "p", "node"]]

    most = targets.agg(F.max(F.ceil(F.col("n_docs") / LEAF))).first()[0] or 1
    levels = max(0, math.ceil(math.log(most, FAN) - 1e-9))
    live = rows.where("p > 0").select("key", "source", "size", "p", "node")
    done = None
    for level in range(levels + 1):
        out = stored(live.groupBy("source", "node").applyInPandas(round_group, schema), f"level{level}")
        settled = out.where("p = 1 or p = 0") if level < levels else out
        done = settled if done is None else done.unionByName(settled)
        live = out.where("p > 0 and p < 1").withColumn("node", F.floor(F.col("node") / FAN).cast("long"))
    # the last fraction of a source goes to a draw of its own
    word = F.concat_ws(":", F.lit(str(seed)), "key")
    draw: Column = F.pmod(F.xxhash64(word), F.lit(1 << 30)) / float(1 << 30)
    extra = done.select("key", F.when((F.col("p") > 0) & (F.col("p") < 1), (draw < F.col("p")).cast("int")).otherwise(F.col("p").cast("int")).alias("extra")).where("extra = 1")
    return rows.join(extra, "key", "left").select("key", "source", "size", "source_size", "target", (F.col("whole") + F.coalesce("extra", F.lit(0))).alias("copies"))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 11) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, copies, number) of each row of docs(doc_id, text, source).

    taken is size times copies; a source's taken words differ from its target by less than the
    size of one document.  Null texts have size 0, null sources are a source, the last one.
    A source or table without words is not taken from.  Rows that repeat a doc_id, source and size
    are told apart by their number, from 1; other columns of docs are ignored.
    """
    sizes = word_sizes(docs)
    many = sizes.groupBy("doc_id", "source", "size").agg(F.count("*").alias("c"))
    rows = many.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("c").cast("int"))))
    key = F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce("source", F.lit("\u0000null")), F.col("size").cast("string"), F.col("copy").cast("string"))
    rows = stored(rows.select(key.alias("key"), "doc_id", "source", "size", F.col("copy").alias("number")), "sizes")
    copies = mix_copies(rows.select("key", "source", "size"), stored(source_targets(rows, weights, share, most), "targets"), seed)
    return rows.select("key", "doc_id", "number").join(copies, "key").select("doc_id", "source", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies", "number")
