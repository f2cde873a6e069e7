"""Substring dedup by a log-structured fingerprint index.

A batch's 13-word windows are gathered under anchors: the smallest hash among the 6-word
grams of a window.  Equal windows have equal anchors, and neighbouring windows mostly share
one, so the index holds one entry (anchor, hash of its whole window group, doc_id) for about
four windows.  Entries lie in immutable runs, sorted by anchor and cut into buckets.  A new
batch is sorted the same way and merge-joined with the runs bucket by bucket:

- the same anchor and the same window group in a smaller document: every window repeats, as
  two independent 64-bit hashes, of a gram and of all windows around it, agree;
- the same anchor with another group: its windows are verified one by one, by two hashes of
  their own, against those of the documents that hold the anchor, from their texts.

A batch adds a run.  As soon as FAN runs have about the same size they are compacted into one
in which an entry keeps its smallest doc_id.  A manifest names the live runs, so that a later
session opens the index where this one left it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textarrays as ta
from .jaccard_join import _pack, _unpack
from .storage import shared_dir, stored

U64 = np.uint64
WINDOW, GRAM = 13, 6
RUN, FULL, CHECK = 0, 1, 2
#: Runs of about one size before they become one, and how much "about" is.
FAN = 4
#: Groups of an anchor in a task's flush before the anchor is hot, and the group that marks it.
CAP, HOT = 64, 0
_BLOCK = "bucket int, n bigint, anchors binary, groups binary, low bigint, ids binary"


def anchored(hashes: np.ndarray, doc: np.ndarray):
    """Windows of a chunk's words and their groups.

    Returns (first word of each window, its hash, its group; anchor, group hash and document of
    each group).
    """
    wins = ta.window_hash(hashes, WINDOW, 13)
    at = np.flatnonzero(doc[: len(wins)] == doc[WINDOW - 1 :]) if len(wins) else np.zeros(0, np.int64)
    none = np.zeros(0, np.int64)
    if not len(at):
        return none, none.astype(U64), none, none.astype(U64), none.astype(U64), none
    value = ta.window_hash(hashes, GRAM, 6)
    grams, place = value, np.arange(len(value))
    for step in (1, 2, 4):  # leftmost smallest of 8 grams
        right = value[step:] < value[:-step]
        value = np.where(right, value[step:], value[:-step])
        place = np.where(right, place[step:], place[:-step])
    place, wins, of = place[at], wins[at], doc[at]
    new = np.ones(len(at), bool)
    new[1:] = (place[1:] != place[:-1]) | (of[1:] != of[:-1])
    cut = np.flatnonzero(new)
    with np.errstate(over="ignore"):
        part = ta.mix(wins ^ ((at - place + 1).astype(U64) * U64(0xC2B2AE3D27D4EB4F)))
        groups = ta.mix(np.add.reduceat(part, cut))
    return at, wins, np.cumsum(new) - 1, grams[place[cut]], groups, of[cut]


def entry_id(anchors: np.ndarray, groups: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ta.mix(anchors + ta.mix(groups)).view(np.int64)


def _blocks(docs: DataFrame, buckets: int) -> DataFrame:
    """A batch's entries, one packed row for each task and bucket.

    Of an entry that a flush holds for several documents the smallest goes to the anchor's bucket;
    the others are known to repeat and go to buckets from `buckets` on, spread by their ids.  An
    anchor with more than CAP groups in a flush is hot: a mark takes its place in its bucket, and
    its entries, which are compared window by window, go to buckets from 2 * `buckets` on.
    """

    def flush(parts: list) -> Iterator[pa.RecordBatch]:
        if not parts:
            return
        anchor, group, ids = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((ids, group, anchor))
        anchor, group, ids = anchor[order], group[order], ids[order]
        a0 = np.ones(len(anchor), bool)
        a0[1:] = anchor[1:] != anchor[:-1]
        g0 = a0.copy()
        g0[1:] |= group[1:] != group[:-1]
        keep = g0.copy()
        keep[1:] |= ids[1:] != ids[:-1]  # a document's second entry of a kind says nothing new
        number = np.cumsum(a0) - 1
        hot = (np.bincount(number, weights=g0) > CAP)[number]
        first = ids[np.maximum.accumulate(np.where(g0, np.arange(len(ids)), 0))]
        spread = (ta.mix(ids.view(U64)) % U64(buckets)).astype(np.int64)
        home = ((anchor >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)
        bucket = np.where(hot, 2 * buckets + spread, np.where(ids > first, buckets + spread, home))
        marks = a0 & hot
        anchor, group, ids = (np.concatenate(x) for x in ((anchor[keep], anchor[marks]), (group[keep], np.full(int(marks.sum()), HOT, U64)), (ids[keep], ids[marks])))
        bucket = np.concatenate([bucket[keep], home[marks]]).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        anchor, group, ids, bucket = anchor[order], group[order], ids[order], bucket[order]
        cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        rows = [(int(bucket[a]), b - a, anchor[a:b].tobytes(), group[a:b].tobytes(), *_pack(ids[a:b])) for a, b in zip(cut.tolist(), np.append(cut[1:], len(anchor)).tolist(), strict=True)]
        for i in range(0, len(rows), 1000):
            yield _block_batch(rows[i : i + 1000])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for lo, hi, data, offs in ta.chunks(batch.column(1)):
                starts, ends, doc = ta.words(data, offs)
                _, _, _, anchor, group, of = anchored(ta.span_hash(data, starts, ends), doc)
                if len(anchor):
                    parts.append((anchor, group, batch.column(0).slice(lo, hi - lo).to_numpy(zero_copy_only=False)[of]))
                    held += len(anchor)
                if held > 1_000_000:
                    yield from flush(parts)
                    parts, held = [], 0
        yield from flush(parts)

    return docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(run, _BLOCK)


def _block_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["bucket", "n", "anchors", "groups", "low", "ids"])


_MERGED = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("entry", pa.int64()), ("bucket", pa.int32()), ("n", pa.int64()), ("anchors", pa.binary()), ("groups", pa.binary()), ("low", pa.int64()), ("ids", pa.binary())])


def _columns(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The anchors, groups and ids of packed rows."""
    read = lambda c: np.concatenate([np.frombuffer(x, U64) for x in t[c].to_pylist()])
    ids = [_unpack(low, raw, n) for low, raw, n in zip(t["low"].to_pylist(), t["ids"].to_pylist(), t["n"].to_pylist(), strict=True)]
    return read("anchors"), read("groups"), np.concatenate(ids)


def _flagged(kind: int, ids: np.ndarray, entry: np.ndarray) -> pa.Table:
    return pa.table({"kind": np.full(len(ids), kind, np.int32), "doc_id": ids, "entry": entry})


def _run_row(bucket: int, anchor: np.ndarray, group: np.ndarray, ids: np.ndarray) -> pa.Table:
    low, off = _pack(ids)
    block = _block_batch([(bucket, len(ids), anchor.tobytes(), group.tobytes(), low, off)])
    return pa.table({"kind": pa.array([RUN], pa.int32()), **{c: block.column(c) for c in block.schema.names}})


def _shaped(tables: list[pa.Table]) -> pa.Table:
    t = pa.concat_tables([x for x in tables if len(x)] or tables[:1], promote_options="default")
    return pa.table([t[f.name] if f.name in t.schema.names else pa.nulls(len(t), f.type) for f in _MERGED], schema=_MERGED)


def _merge(blocks: DataFrame, runs: list[DataFrame], buckets: int) -> DataFrame:
    """Merge-joins a batch with the live runs, bucket by bucket.

    Rows (kind, doc_id, entry) say of a document's entry that it repeats (FULL) or that its
    windows must be compared (CHECK); rows of kind RUN are the batch's own run.
    """
    rows = blocks.withColumn("old", F.lit(0))
    for r in runs:
        rows = rows.unionByName(r.select("bucket", "n", "anchors", "groups", "low", "ids", F.lit(1).alias("old")))

    def join(t: pa.Table) -> pa.Table:
        bucket = t["bucket"][0].as_py()
        anchor, group, ids = _columns(t)
        if bucket >= buckets:
            return _shaped([_flagged(FULL if bucket < 2 * buckets else CHECK, ids, entry_id(anchor, group))])
        old = np.repeat(np.array(t["old"].to_pylist(), bool), t["n"].to_pylist())
        if old.all():
            return _shaped([_flagged(FULL, ids[:0], ids[:0])])
        order = np.lexsort((ids, group, anchor))
        anchor, group, ids, old = anchor[order], group[order], ids[order], old[order]
        a0 = np.ones(len(anchor), bool)
        a0[1:] = anchor[1:] != anchor[:-1]
        g0 = a0.copy()
        g0[1:] |= group[1:] != group[:-1]
        first = np.maximum.accumulate(np.where(g0, np.arange(len(ids)), 0))  # an entry's smallest document
        full = ids > ids[first]
        # an anchor with several groups: the first document of each group has its windows compared
        number = np.cumsum(a0) - 1
        start = np.flatnonzero(a0)
        hot = np.logical_or.reduceat(group == HOT, start)[number]
        mixed = (np.bincount(number, weights=g0) > 1)[number]
        several = (np.maximum.reduceat(ids, start) > np.minimum.reduceat(ids, start))[number]
        fresh = np.maximum.reduceat((~old).astype(np.int8), start).astype(bool)[number]
        check = g0 & (mixed & several & fresh | hot) & (group != HOT)
        entry = entry_id(anchor, group)
        out = [_flagged(kind, ids[at], entry[at]) for kind, at in ((FULL, full & ~old & (group != HOT)), (CHECK, check))]
        mine = np.flatnonzero(~old)
        new = np.ones(len(mine), bool)
        new[1:] = (anchor[mine[1:]] != anchor[mine[:-1]]) | (group[mine[1:]] != group[mine[:-1]])
        mine = mine[new]
        return _shaped([*out, _run_row(bucket, anchor[mine], group[mine], ids[mine])])

    return rows.groupBy("bucket").applyInArrow(join, f"kind int, doc_id bigint, entry bigint, {_BLOCK}")


def _compact(runs: list[DataFrame]) -> DataFrame:
    """One run of several: an entry keeps its smallest document."""
    rows = runs[0]
    for r in runs[1:]:
        rows = rows.unionByName(r)

    def join(t: pa.Table) -> pa.Table:
        anchor, group, ids = _columns(t)
        order = np.lexsort((ids, group, anchor))
        anchor, group, ids = anchor[order], group[order], ids[order]
        new = np.ones(len(ids), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (group[1:] != group[:-1])
        return _run_row(t["bucket"][0].as_py(), anchor[new], group[new], ids[new]).drop_columns(["kind"])

    return rows.select("bucket", "n", "anchors", "groups", "low", "ids").groupBy("bucket").applyInArrow(join, _BLOCK)


class FingerprintIndex:
    """The index under a folder: its live runs, and what the batches so far have shown.

    Batches must come in ascending doc_id order, as a window is judged against smaller ids.
    `buckets` stays as it is made; take about one for 500,000 entries, which are about as many as
    25 bytes of text each.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.path = path or shared_dir(spark) + "-index"
        self.buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.version, self.highest = 0, None
        #: (folder, entries) of each live run; folders of flags.
        self.runs: list[tuple[str, int]] = []
        self.flagged: list[str] = []

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> FingerprintIndex:
        """The index that an earlier session left at path: the newest manifest that is whole."""
        fs = spark._jvm.org.apache.hadoop.fs
        root = fs.Path(path)
        system = root.getFileSystem(spark._jsc.hadoopConfiguration())
        names = [f.getPath().getName() for f in system.listStatus(root)]
        whole = [int(n.split("-")[1]) for n in names if n.startswith("manifest-") and system.exists(fs.Path(f"{path}/{n}/_SUCCESS"))]
        rows = spark.read.parquet(f"{path}/manifest-{max(whole)}").collect()  # a row for each run and each batch's flags
        meta = next(r for r in rows if r.kind == "index")
        self = cls(spark, path, meta.n)
        self.version, self.highest = max(whole), meta.highest
        self.runs = [(r.folder, r.n) for r in rows if r.kind == "run"]
        self.flagged = [r.folder for r in sorted(rows, key=lambda r: r.n) if r.kind == "flags"]
        return self

    def _commit(self) -> None:
        self.version += 1
        rows = [("index", "", self.buckets, self.highest)] + [("run", f, n, None) for f, n in self.runs] + [("flags", f, i, None) for i, f in enumerate(self.flagged)]
        self.spark.createDataFrame(rows, "kind string, folder string, n bigint, highest bigint").coalesce(1).write.parquet(f"{self.path}/manifest-{self.version}")

    def _table(self, folder: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{folder}")

    @property
    def flags(self) -> DataFrame:
        """(kind, doc_id, entry) of all batches."""
        out = self.spark.createDataFrame([], "kind int, doc_id bigint, entry bigint")
        for folder in self.flagged:
            out = out.unionByName(self._table(folder, "kind int, doc_id bigint, entry bigint").where(F.col("kind") != RUN))
        return out

    def add(self, batch: DataFrame, keep_run: bool = True) -> DataFrame:
        """Merge-joins a batch(doc_id, text); returns its flags (kind, doc_id, entry).

        The batch's own run and flags are one table, as they come from one pass.
        """
        low, high = batch.agg(F.min("doc_id"), F.max("doc_id")).first()
        if low is not None and self.highest is not None and low <= self.highest:
            raise ValueError(f"doc_id {low} does not follow {self.highest}, the highest of the batches before")
        folder = f"batch-{self.version + 1}"
        merged = _merge(_blocks(batch, self.buckets), [self._table(f, _BLOCK).where("bucket is not null") for f, _ in self.runs], self.buckets)
        if not keep_run:
            merged = merged.where(F.col("kind") != RUN)
        merged.write.option("compression", "zstd").parquet(f"{self.path}/{folder}")
        self.highest = high if low is not None else self.highest
        self.flagged.append(folder)
        if keep_run:
            entries = self._table(folder, f"kind int, {_BLOCK}").where(F.col("kind") == RUN).agg(F.sum("n")).first()[0] or 0
            self.runs.append((folder, entries))
            self._compacted()
        self._commit()
        return self._table(folder, "kind int, doc_id bigint, entry bigint").where(F.col("kind") != RUN)

    def _compacted(self) -> None:
        """Merges FAN runs of one tier, a power of FAN, until no tier has so many."""
        tier = lambda n: max(n, 1).bit_length() // 2
        while True:
            full = [t for t in {tier(n) for _, n in self.runs} if sum(tier(n) == t for _, n in self.runs) >= FAN]
            if not full:
                return
            old = [r for r in self.runs if tier(r[1]) == min(full)]
            folder = f"run-{self.version + 1}-{min(full)}"
            _compact([self._table(f, _BLOCK).where("bucket is not null") for f, _ in old]).write.option("compression", "zstd").parquet(f"{self.path}/{folder}")
            entries = self._table(folder, _BLOCK).agg(F.sum("n")).first()[0] or 0
            self.runs = [r for r in self.runs if r not in old] + [(folder, entries)]


def _compared(rows: DataFrame) -> DataFrame:
    """(w1, w2, doc_id): the windows of the entries to be compared, as 128-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in ta.chunks(batch.column(1)):
                ids = batch.column(0).slice(lo, hi - lo).to_numpy(zero_copy_only=False)
                starts, ends, doc = ta.words(data, offs)
                hashes = ta.span_hash(data, starts, ends)
                at, wins, group, anchor, groups, of = anchored(hashes, doc)
                hit = _listed(entry_id(anchor, groups), of, batch.column(2).slice(lo, hi - lo))[group]
                other = ta.window_hash(ta.span_hash(data, starts, ends, 99), WINDOW, 99)[at[hit]] if hit.any() else wins[:0]
                yield pa.RecordBatch.from_arrays([pa.array(wins[hit].view(np.int64)), pa.array(other.view(np.int64)), pa.array(ids[of[group[hit]]], pa.int64())], names=["w1", "w2", "doc_id"])

    return rows.mapInArrow(run, "w1 bigint, w2 bigint, doc_id bigint")


def _listed(values: np.ndarray, doc: np.ndarray, lists: pa.Array) -> np.ndarray:
    """Which values are in the list of their document."""
    if not len(lists.flatten()):
        return np.zeros(len(values), bool)
    size = np.array([0 if x is None else x for x in lists.value_lengths().to_pylist()], np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore"):
        salt = ta.mix(np.arange(1, len(lists) + 1, dtype=U64))
        have = np.unique(ta.mix(flat.view(U64) ^ salt[np.repeat(np.arange(len(lists)), size)]))
        want = ta.mix(values.view(U64) ^ salt[doc])
    at = np.minimum(np.searchsorted(have, want), len(have) - 1)
    return have[at] == want


def removed_words(docs: DataFrame, flags: DataFrame, keep_text: bool = False) -> DataFrame:
    """docs with n_words, n_removed and the kept words' SHA-256, or the kept text, from all flags."""
    # names that no column of docs has
    full, check, repeats = (next(n for k in range(len(docs.columns) + 1) if (n := f"__{word}{k}") not in docs.columns) for word in ("full", "check", "again"))
    lists = [F.collect_list(F.when(F.col("kind") == kind, F.col("entry"))).alias(name) for kind, name in ((FULL, full), (CHECK, check))]
    marked = docs.join(flags.groupBy("doc_id").agg(*lists), "doc_id", "left")
    wins = stored(_compared(marked.where(F.size(check) > 0).select("doc_id", "text", check)).distinct(), "windows")
    first = wins.groupBy("w1", "w2").agg(F.min("doc_id").alias("first"))
    again = wins.join(first, ["w1", "w2"]).where("doc_id > first").groupBy("doc_id").agg(F.collect_list("w1").alias(repeats))
    rows = marked.drop(check).join(again, "doc_id", "left")
    carry = [f for f in docs.schema.fields if f.name != "text"]
    rows = rows.select(*[f.name for f in carry], "text", full, repeats)
    added = [("n_words", pa.int64()), ("n_removed", pa.int64()), ("text" if keep_text else "kept_sha256", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in ta.chunks(batch.column(len(carry))):
                starts, ends, doc = ta.words(data, offs)
                at, wins, group, anchor, groups, of = anchored(ta.span_hash(data, starts, ends), doc)
                part = lambda i: batch.column(len(carry) + i).slice(lo, hi - lo)  # noqa: B023, E731
                gone = _listed(entry_id(anchor, groups), of, part(1))[group] | _listed(wins, of[group], part(2))
                drop = ta.covered(at[gone], WINDOW, len(doc))
                n_words = np.bincount(doc, minlength=hi - lo)
                n_removed = np.bincount(doc[drop], minlength=hi - lo)
                raw, ends_at, out = data.tobytes(), np.cumsum(n_words), []
                for i in range(hi - lo):
                    if keep_text and not n_removed[i]:
                        out.append(raw[offs[i] : offs[i + 1]].decode("utf-8", "replace"))
                        continue
                    w = raw[offs[i] : offs[i + 1]].split()
                    if n_removed[i]:
                        w = compress(w, ~drop[ends_at[i] - n_words[i] : ends_at[i]])
                    w = b" ".join(w)
                    out.append(w.decode("utf-8", "replace") if keep_text else hashlib.sha256(w).hexdigest())
                cols = [batch.column(i).slice(lo, hi - lo) for i in range(len(carry))]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(n_words), pa.array(n_removed), pa.array(out, pa.string())], names=[*[f.name for f in carry], *[a for a, _ in added]])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in carry] + ["n_words bigint", "n_removed bigint", f"{added[2][0]} string"])
    return rows.mapInArrow(run, schema)


def substring_dedup(docs: DataFrame, batches: int = 2, keep_text: bool = False) -> DataFrame:
    """Removes each word covered by a 13-word window that also starts in a smaller doc_id.

    Returns docs without its text and with n_words, n_removed and kept_sha256, of the kept words
    joined by one space (or, if keep_text, with these words as text; a text that loses none stays
    as it is).  docs is added to an empty index in
    `batches` batches of ascending doc_id.  Null and empty texts have no words; texts of fewer
    than 13 words keep all; a row with a null doc_id is compared with nothing; rows with the
    same doc_id do not remove each other's words.
    """
    docs = docs.drop("n_words", "n_removed", "kept_sha256")  # a column of such a name is replaced
    splits = docs.select(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 1000)).first()[0] if batches > 1 else []
    edges = sorted(set(splits or []))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    index = FingerprintIndex(docs.sparkSession, buckets=max(4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // 12_500_000))
    for i in range(len(edges) + 1):
        batch = docs.select("doc_id", "text")
        if i:
            batch = batch.where(F.col("doc_id") > edges[i - 1])
        if i < len(edges):
            batch = batch.where(F.col("doc_id") <= edges[i])
        index.add(batch, keep_run=i < len(edges))
    return removed_words(docs, index.flags, keep_text)
