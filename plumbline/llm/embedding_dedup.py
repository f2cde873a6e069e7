"""Near duplicates among embeddings by sorted projection passes.

Each pass sorts the vectors by the concatenated bits of its own random hyperplanes and
compares every vector with those at most WINDOW places before it.  It also measures for every
vector, from the keys at the ends of its window, how likely a partner at the threshold lies
inside.  Vectors that the passes serve too badly, as those of a dense cluster, get more passes
among themselves, or are compared with each other in full where that is cheaper.  Links of all
passes are united; inside the components found this way every pair is then compared in blocks,
so that a component larger than the windows still has all of its links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .storage import stored

WINDOW = 256
BITS = 63
BLOCK = 512
#: Rows of a block where vectors are compared in full.
TILE = 2048
#: Rows whose chances are computed at a time.
CHUNK = 4096


def passes_for(n: int, threshold: float, miss: float = 1e-3) -> int:
    """How many passes leave a pair at the threshold unmet with a chance of `miss`, if cells fill evenly.

    A pair shares a bit with chance 1 - angle / pi, and lies within a window if it shares about
    log2(n / WINDOW) leading bits.  What the passes reach on the given vectors is measured.
    """
    bits = max(1.0, math.log2(max(2, n) / WINDOW))
    met = (1 - math.acos(threshold) / math.pi) ** bits
    return max(4, math.ceil(math.log(miss) / math.log(1 - met)))


def vectors(df: DataFrame) -> DataFrame:
    """(vec_id, raw, digest): each usable vector as unit-length doubles and its direction's bytes.

    Vectors that are null, empty, zero or hold null or non-finite components are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, raw = [], []
            for i, e in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if i is None or not e.is_valid or e.values.null_count or not len(e.values):
                    continue
                x = e.values.to_numpy(zero_copy_only=False).astype(np.float64)
                top = np.abs(x).max()
                if np.isfinite(top) and top > 0:
                    ids.append(i)
                    raw.append(e.values.to_numpy(zero_copy_only=False).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(raw, pa.binary())], names=["vec_id", "raw"])

    return df.select("vec_id", "embedding").mapInArrow(run, "vec_id bigint, raw binary")


def _unit(raw: list[bytes], kind: str) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _planes(seed: int, dim: int, p: int) -> np.ndarray:
    return np.random.default_rng((seed, dim, p)).standard_normal((dim, BITS))


def _keys(reps: DataFrame, passes: range, kind: str, seed: int) -> DataFrame:
    """(pass, width, key, tie, vec_id, raw), a row per vector and pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[tuple[int, int], np.ndarray] = {}
        weights = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            ids, raw = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            size = np.array([len(r) for r in raw])
            for width in np.unique(size).tolist():
                rows = np.flatnonzero(size == width)
                x = _unit([raw[i] for i in rows], kind)
                dim = x.shape[1]
                for p in passes:
                    if (dim, p) not in planes:
                        planes[dim, p] = _planes(seed, dim, p)
                    key = ((x @ planes[dim, p]) > 0) @ weights
                    tie = np.random.default_rng((seed, 1, p)).integers(1, 2**62) ^ ids[rows]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), p, np.int32)), pa.array(np.full(len(rows), width, np.int32)), pa.array(key), pa.array(tie), pa.array(ids[rows]), pa.array([raw[i] for i in rows], pa.binary())], names=["pass", "width", "key", "tie", "vec_id", "raw"])

    return reps.select("vec_id", "raw").mapInArrow(run, "pass int, width int, key bigint, tie bigint, vec_id bigint, raw binary")


def flip_chances(x: np.ndarray, planes: np.ndarray, threshold: float) -> np.ndarray:
    """How likely each bit of each unit vector differs in a partner at the threshold, in a random direction from it."""
    m = x @ planes
    if threshold >= 1:
        return np.zeros_like(m)
    rest = np.sqrt(np.maximum((planes * planes).sum(0) - m * m, 1e-300) / max(1, x.shape[1] - 1))
    z = threshold * np.abs(m) / (math.sqrt(1 - threshold * threshold) * rest)
    return 0.5 * (1 - np.tanh(0.7978845608 * (z + 0.044715 * z**3)))


def window_chances(keys: np.ndarray, flips: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """How likely a partner's key lies between low and high, both left out; below 0 a bound is none."""
    shifts = np.arange(BITS - 1, -1, -1, dtype=np.int64)
    mine = (keys[:, None] >> shifts) & 1

    def above(bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bits = (bound[:, None] >> shifts) & 1
        same = np.where(bits == mine, 1 - flips, flips)
        lead = np.cumprod(same, 1)
        before = np.concatenate([np.ones((len(keys), 1)), lead[:, :-1]], 1)
        return ((bits == 0) * (1 - same) * before).sum(1), lead[:, -1]

    over, _ = above(low)
    past, at = above(high)
    return np.clip(np.where(low < 0, 1.0, over) - np.where(high < 0, 0.0, past + at), 0.0, 1.0)


def _spanning(ids: np.ndarray, near: np.ndarray, label: np.ndarray, old: int, reach: int) -> list[tuple]:
    """Links (a, b) that join what near joins: rows old.. with at most `reach` rows before them.  Relabels in place."""
    found = []
    for i in np.flatnonzero(near.sum(1) > 1).tolist():
        at = old + i
        other = np.flatnonzero(near[i, max(0, at - reach) : at]) + max(0, at - reach)
        for j in other[np.unique(label[other], return_index=True)[1]].tolist():
            if label[j] != label[at] and ids[j] != ids[at]:
                found.append((ids[at], ids[j]))
                label[label == label[j]] = label[at]
    return found


def _window_links(rows: DataFrame, threshold: float, kind: str, seed: int) -> DataFrame:
    """(a, b, unmet): a spanning set of the links within each window of the sorted rows, and for
    each row, with b null, the logarithm of the chance that its window misses a partner at the threshold.

    A window ends with the partition, which the chances take into account.
    """

    def table(a: list, b: list | None, unmet: np.ndarray | None) -> pa.RecordBatch:
        none = pa.nulls(len(a), pa.int64()), pa.nulls(len(a), pa.float64())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), none[0] if b is None else pa.array(b, pa.int64()), none[1] if unmet is None else pa.array(unmet)], names=["a", "b", "unmet"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, x, label, fresh = np.zeros(0, np.int64), None, np.zeros(0, np.int64), 0
        group, planes = None, None
        opens = TaskContext.get().partitionId() == 0  # whether the group is known to start where its rows here do
        # rows still without their chances, after as many before them as a window needs
        wait_ids, wait_keys, flips, done = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, BITS)), 0

        def chances(ends: bool, last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal wait_ids, wait_keys, flips, done, opens
            n, reach = len(wait_keys), WINDOW + 1
            to = n if last else max(done, n - reach)
            for lo in range(done, to, CHUNK):
                i = np.arange(lo, min(to, lo + CHUNK))
                low = np.where(i >= reach, wait_keys[np.maximum(i - reach, 0)], -1 if opens else wait_keys[0])
                high = np.where(i + reach < n, wait_keys[np.minimum(i + reach, n - 1)], -1 if ends else wait_keys[-1])
                yield table(wait_ids[i], None, np.log(np.maximum(1 - window_chances(wait_keys[i], flips[i], low, high), 1e-12)))
            cut = max(0, to - reach)
            opens = opens and not cut
            wait_ids, wait_keys, flips, done = wait_ids[cut:], wait_keys[cut:], flips[cut:], to - cut

        for batch in batches:
            passes, widths, keys = (batch.column(k).to_numpy() for k in range(3))
            got, raw = batch.column(3).to_numpy(), batch.column(4).to_pylist()
            cut = [0, *(np.flatnonzero((np.diff(passes) != 0) | (np.diff(widths) != 0)) + 1).tolist(), len(got)]
            for start, stop in zip(cut[:-1], cut[1:], strict=True):
                if start == stop:
                    continue
                if group != (passes[start], widths[start]):
                    if group:
                        yield from chances(True, True)
                        opens = True
                    group = (passes[start], widths[start])
                    wait_ids, wait_keys, flips, done = wait_ids[:0], wait_keys[:0], flips[:0], 0
                    x = None
                for lo in range(start, stop, WINDOW):
                    hi = min(stop, lo + WINDOW)
                    new = _unit(raw[lo:hi], kind)
                    if x is None:
                        ids, x, label = ids[:0], new[:0], label[:0]
                        planes = _planes(seed, new.shape[1], int(group[0]))
                    old = len(ids)
                    ids, x = np.concatenate([ids, got[lo:hi]]), np.concatenate([x, new])
                    label = np.concatenate([label, np.arange(fresh, fresh + len(new))])
                    fresh += len(new)
                    found = _spanning(ids, new @ x.T >= threshold, label, old, WINDOW)
                    ids, x, label = ids[-WINDOW:], x[-WINDOW:], label[-WINDOW:]
                    if found:
                        yield table([f[0] for f in found], [f[1] for f in found], None)
                    wait_ids, wait_keys = np.concatenate([wait_ids, got[lo:hi]]), np.concatenate([wait_keys, keys[lo:hi]])
                    flips = np.concatenate([flips, flip_chances(new, planes, threshold)])
                    if len(wait_keys) - done > CHUNK + WINDOW:
                        yield from chances(False, False)
        if group:
            yield from chances(False, True)

    return rows.select("pass", "width", "key", "vec_id", "raw").mapInArrow(run, "a bigint, b bigint, unmet double")


def _full_links(hot: DataFrame, n: int, threshold: float, kind: str) -> DataFrame:
    """(a, b): links that join what the links of all pairs of hot(vec_id, raw) join, tile by tile."""
    blocks = math.ceil(n / TILE)
    s = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    places = hot.select("vec_id", "raw", s.alias("s")).withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    rows = places.select(F.least("s", "t").alias("x"), F.greatest("s", "t").alias("y"), "vec_id", "raw").repartition("x", "y").sortWithinPartitions("x", "y")

    def links(block: list[tuple]) -> Iterator[pa.RecordBatch]:
        for width in {len(r[1]) for r in block}:
            same = [r for r in block if len(r[1]) == width]
            ids, u = np.array([r[0] for r in same]), _unit([r[1] for r in same], kind)
            found = _spanning(ids, u @ u.T >= threshold, np.arange(len(ids)), 0, len(ids))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, block = None, []
        for batch in batches:
            for r in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if r[:2] != tile:
                    yield from links(block)
                    tile, block = r[:2], []
                block.append(r[2:])
        yield from links(block)

    return rows.mapInArrow(run, "a bigint, b bigint")


def _links(reps: DataFrame, threshold: float, kind: str, seed: int, miss: float) -> DataFrame:
    """(a, b): links that join what all links join, but for a pair at the threshold with a chance of `miss`."""
    n, goal = reps.count(), math.log(miss)
    hot, links, unmet, first, more = reps, None, None, 0, passes_for(n, threshold, miss)
    while True:
        keyed = _keys(hot, range(first, first + more), kind, seed).repartitionByRange("pass", "width", "key", "tie").sortWithinPartitions("pass", "width", "key", "tie")
        met = stored(_window_links(keyed, threshold, kind, seed), "links")
        new = met.where("b is not null").select("a", "b")
        links = new if links is None else links.unionByName(new)
        # a pair is lost only if both of its rows are badly served
        now = met.where("b is null").groupBy(F.col("a").alias("vec_id")).agg(F.sum("unmet").alias("unmet"))
        if unmet is not None:
            now = now.unionByName(unmet).groupBy("vec_id").agg(F.sum("unmet").alias("unmet"))
        first, before = first + more, n
        unmet = stored(now.where(F.col("unmet") > goal), "unmet")
        n, slow = unmet.agg(F.count("*"), F.percentile_approx("unmet", 0.9)).first()
        if n < 2:
            break
        hot = stored(reps.join(unmet.select("vec_id"), "vec_id"), "hot")
        more = math.ceil(first * (goal / min(slow, -1e-9) - 1)) + 1
        if n <= 4 * WINDOW * more or n > 0.7 * before and first > more:  # comparing all pairs is cheaper, or further passes do not help
            links = links.unionByName(_full_links(hot, n, threshold, kind))
            break
    return stored(links.distinct(), "links")


def _count_links(found: DataFrame, reps: DataFrame, threshold: float, kind: str) -> DataFrame:
    """(vec_id, n): rows linked with each representative, over all pairs of its component.

    Members are dealt into blocks by a hash; a tile is two blocks of one component.
    """
    size = found.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    places = found.join(size, "component").withColumn("s", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    places = places.withColumn("t", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    places = places.select(F.col("id").alias("vec_id"), "component", F.least("s", "t").alias("x"), F.greatest("s", "t").alias("y"), "s")
    rows = places.join(reps, "vec_id").select("component", "x", "y", "s", "vec_id", "raw", "c")
    rows = rows.repartition("component", "x", "y").sortWithinPartitions("component", "x", "y")

    def links(block: list[tuple], x: int, y: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for width in {len(r[2]) for r in block}:
            same = [r for r in block if len(r[2]) == width]
            ids, c, s = (np.array([r[k] for r in same]) for k in (1, 3, 0))
            near = (u := _unit([r[2] for r in same], kind)) @ u.T >= threshold
            np.fill_diagonal(near, False)
            if x != y:  # pairs of one block are its own tile's
                near &= s[:, None] != s[None, :]
            yield ids, near @ c

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, block = None, []
        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns]
            for r in zip(*cols, strict=True):
                if r[:3] != tile:
                    for ids, n in links(block, *tile[1:]) if tile else ():
                        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64())], names=["vec_id", "n"])
                    tile, block = r[:3], []
                block.append(r[3:])
        for ids, n in links(block, *tile[1:]) if tile else ():
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64())], names=["vec_id", "n"])

    return rows.mapInArrow(run, "vec_id bigint, n bigint").groupBy("vec_id").agg(F.sum("n").alias("n"))


def embedding_dedup(df: DataFrame, threshold: float = 0.95, seed: int = 7, miss: float = 1e-3) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row of df(vec_id, embedding).

    Pairs whose cosine in double precision is `threshold` or more are linked; a pair at the
    threshold is found with a chance of 1 - miss, as measured for each row on its windows, a
    nearer one with more, and none below it is linked.  Equal vectors are one class, compared once and counted in full.  Unusable vectors
    (see `vectors`) and rows with a null vec_id link with nothing; vectors of different lengths
    never link.  Vectors of other numbers than float are compared as double.  Other columns are ignored.
    """
    if dict(df.dtypes)["embedding"] not in ("array<float>", "array<double>"):
        df = df.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    kind = "float64" if "double" in dict(df.dtypes)["embedding"] else "float32"
    all_rows = df.select("vec_id")
    # equal bytes, equal vectors: of a class only the smallest id takes part
    usable = vectors(df)
    classes = usable.groupBy(F.sha2("raw", 256).alias("digest")).agg(F.min_by("raw", "vec_id").alias("raw"), F.min("vec_id").alias("vec_id"), F.count("*").alias("c"))
    classes = stored(classes, "classes")
    # one id can hold several vectors if rows repeat it: its classes are one node
    reps = classes.select("vec_id", "raw", "c")
    of = stored(usable.select("vec_id", F.sha2("raw", 256).alias("digest")).join(classes.select("digest", F.col("vec_id").alias("rep"), "c"), "digest").select("vec_id", "rep", "c"), "members")
    links = _links(reps, threshold, kind, seed, miss)
    found = stored(connected_components(links), "found")
    counts = _count_links(found, reps, threshold, kind)
    per = of.join(counts.withColumnRenamed("vec_id", "rep"), "rep", "left").join(found.withColumnRenamed("id", "rep"), "rep", "left")
    per = per.select("vec_id", (F.coalesce("n", F.lit(0)) + F.col("c") - 1).alias("n"), F.coalesce("component", "rep").alias("component"))
    per = per.groupBy("vec_id").agg(F.max("n").alias("n"), F.min("component").alias("component"))
    out = all_rows.join(per, "vec_id", "left").select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
