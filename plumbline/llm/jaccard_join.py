"""Exact n-gram Jaccard join: size-banded tiles, bitmap bounds, then sorted-array intersection.

1. Equal sets are one class, represented by the smallest doc_id.
2. A set of s shingles is cut at fixed places of the hash space into P parts, P depending
   on its size band.  Two sets with similarity t differ in at most (1-t)/(1+t) * (|A|+|B|)
   shingles, fewer than P less the parts that are nearly empty, so they agree in a whole
   part and meet under that part's hash.  Small sets, and sets with many nearly empty
   parts, meet under their shingles instead.  Both meetings are certain, so no link is lost.
   Linked sets agree in many keys, not in one, so pairs are counted and those with fewer common
   keys than a link has are gone.
3. A key that few classes share gives pairs.  A key that many share is a star: its members are
   compared with its hub, then those outside the largest group that links have joined so far with
   the others, in tiles of a key and its size band.  A class whose links share c keys or more leaves its c - 1 most
   frequent ones out (a link keeps its rarest common key), so common passages make no tiles.
4. The bits that two hashed bitmaps lack bound the overlap from above, before any set is sent
   anywhere; what passes is intersected exactly, each set being sent once to a hub or tile.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textarrays as ta
from .components import connected_components
from .storage import dropped, stored

U64 = np.uint64
#: Sets up to this many shingles have no parts.
SMALL = 64
RATIO = 1.5
FEW = 8
#: Parts for each shingle in which partners can differ.
PARTS = 1.8
BLOCK = 256
#: Shingles of a block at most, but for a single larger set.
WEIGHT = 1 << 20
#: Members of a tile, of either kind.
TILE = 2048
#: Documents that share a key in a flush before the key is hot there, and the mark of such a key.
CAP, MARK = 64, 255
#: Ids of rows whose texts are read again may be broadcast up to this many (16 bytes each in a hashed relation).
BROADCAST_IDS = 1_000_000


def shingle_sets(data: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all documents, document bounds in them).

    A text of fewer than k words gives its whole word sequence as one shingle; a text
    without words gives none.
    """
    n = len(offs) - 1
    data = ta.LOWER[data]
    starts, ends, doc = ta.words(data, offs)
    h = ta.span_hash(data, starts, ends)
    w = ta.window_hash(h, k)
    at = np.flatnonzero(doc[: len(w)] == doc[k - 1 :]) if len(w) else np.zeros(0, np.int64)
    values, owner = w[at], doc[at]
    count = np.bincount(doc, minlength=n)
    for m in range(1, k):
        rows = np.flatnonzero(count == m)
        if len(rows):
            first = np.searchsorted(doc, rows)
            short = ta.window_hash(h, m, 100 + m)[first]
            values, owner = np.concatenate([values, short]), np.concatenate([owner, rows])
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[new], owner[new]
    return values, np.searchsorted(owner, np.arange(n + 1))


class Bands:
    """Size bands for one threshold num/den, with the number of parts of each."""

    def __init__(self, num: int, den: int, largest: int):
        self.num, self.den = num, den
        self.edges = [SMALL + 1]
        while self.edges[-1] <= largest:
            self.edges.append(int(self.edges[-1] * RATIO) + 1)
        hi = np.array(self.edges[1:] or [SMALL + 2], np.int64) - 1
        self.reach = hi * den // num  # the largest partner of a set in the band
        differ = ((hi + self.reach) * (den - num)) // (den + num)
        # so many that two or three shingles fall in a part: then most parts beyond those that differ are full
        self.parts = (differ * PARTS).astype(np.int64) + 4

    def differ(self, sizes: np.ndarray) -> np.ndarray:
        """How many shingles a set and its largest partner can differ in."""
        return (sizes + sizes * self.den // self.num) * (self.den - self.num) // (self.den + self.num)

    def shared(self, sizes: np.ndarray) -> np.ndarray:
        """How many shingles a set shares with any partner at least."""
        return -(-sizes * self.num // self.den)


def keys_of(values: np.ndarray, bounds: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, document of each, how many keys of its kind the document may leave out): two sets with
    similarity num/den or more share a key.

    Keys of parts are odd, those of single shingles even.  A link of two sets that have even keys
    shares all that the sets share, which is `shared` or more; another link shares as many odd ones
    as `needed` says: what is left of P parts after those that differ and those that are nearly
    empty, of which a set without even keys has P - differ(its size) - 1 at most.  A set with f
    full parts shares f - differ(its size) of them or more with any partner.
    """
    sizes = np.diff(bounds)
    bands = Bands(num, den, int(sizes.max(initial=0)))
    edges = np.array(bands.edges)
    band = np.searchsorted(edges, sizes, "right") - 1  # -1: small
    keys, owner, spares = [], [], []
    overflow, spare = np.zeros(len(sizes), bool), np.full(len(sizes), MARK, np.int64)
    below = (band >= 1) & (sizes <= bands.reach[np.maximum(band - 1, 0)])
    for tile, rows in ((band, np.flatnonzero(band >= 0)), (band - 1, np.flatnonzero(below))):
        if not len(rows):
            continue
        parts = bands.parts[tile[rows]]
        length = sizes[rows]
        base = np.cumsum(length) - length
        local = np.repeat(np.arange(len(rows)), length)
        v = values[np.arange(int(length.sum())) - np.repeat(base - bounds[rows], length)]
        part = ((v >> U64(32)) * parts[local].astype(U64) >> U64(32)).astype(np.int64)
        cut = np.flatnonzero(np.concatenate([[True], (part[1:] != part[:-1]) | (local[1:] != local[:-1])]))
        width = np.diff(np.append(cut, len(v)))
        with np.errstate(over="ignore"):
            total = np.add.reduceat(ta.mix(v), cut)
            total = ta.mix(total + width.astype(U64) * U64(0x9FB21C651E98DF25) + (tile[rows][local[cut]].astype(U64) << U64(32)) + part[cut].astype(U64))
        good = width >= 2
        full = np.bincount(local[cut][good], minlength=len(rows))
        overflow[rows[full <= bands.differ(length)]] = True
        spare[rows] = np.minimum(spare[rows], full - bands.differ(length) - 1)
        keys.append(total[good] | U64(1))
        owner.append(rows[local[cut][good]])
    spares = [np.maximum(spare, 0)[o] for o in owner]
    for salt, rows in ((1, np.flatnonzero((sizes > 0) & (sizes <= SMALL * den // num))), (2, np.flatnonzero(overflow))):
        length = sizes[rows]
        base = np.cumsum(length) - length
        at = np.arange(int(length.sum())) - np.repeat(base - bounds[rows], length)
        keys.append(ta.mix(values[at] ^ U64(0xA24BAED4963EE407 * salt & (2**64 - 1))) & ~U64(1))
        owner.append(np.repeat(rows, length))
        spares.append(np.repeat(bands.shared(length) - 1, length))
    return np.concatenate(keys), np.concatenate(owner), np.minimum(np.concatenate(spares), MARK - 1).astype(np.uint8)


def needed(num: int, den: int):
    """Common parts that a link of sizes na and nb has at least, unless both have even keys."""
    small = F.least("na", "nb")
    most = F.floor((small + F.floor(small * den / num)) * (den - num) / (den + num))
    return most - F.floor((F.col("na") + F.col("nb")) * (den - num) / (den + num)) + 1


def _pack(ids: np.ndarray) -> tuple[int, bytes]:
    """Ids as offsets from the smallest, in as few bytes as they need."""
    low = int(ids.min())
    off = (ids.astype(np.int64) - low).astype(U64) if int(ids.max()) - low < 2**63 else ids.astype(U64)
    for kind in (np.uint16, np.uint32):
        if int(off.max()) <= np.iinfo(kind).max:
            return low, off.astype(kind).tobytes()
    return (low, off.tobytes()) if int(ids.max()) - low < 2**63 else (0, off.tobytes())


def _unpack(low: int, raw: bytes, n: int) -> np.ndarray:
    kind = {2: np.uint16, 4: np.uint32, 8: U64}[len(raw) // n]
    return np.frombuffer(raw, kind).astype(np.int64) + low


def _set_hashes(values: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit hashes of each set; equal sets have equal hashes."""
    out = []
    for salt in (U64(0x2545F4914F6CDD1D), U64(0x6A09E667F3BCC909)):
        with np.errstate(over="ignore"):
            total = np.concatenate([[U64(0)], np.cumsum(ta.mix(values ^ salt), dtype=U64)])
            out.append(ta.mix(total[bounds[1:]] - total[bounds[:-1]]).view(np.int64))
    return out


def _measure(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n_shingles, h1, h2) of every row; equal sets have equal hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in ta.chunks(batch.column(1)):
                values, bounds = shingle_sets(data, offs, k)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(np.diff(bounds)), *map(pa.array, _set_hashes(values, bounds))], names=["doc_id", "n_shingles", "h1", "h2"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n_shingles bigint, h1 bigint, h2 bigint")


def _blocks(docs: DataFrame, k: int, num: int, den: int, buckets: int) -> DataFrame:
    """Packed keys: a task's keys of one bucket are one row, so a shuffle row holds thousands.

    A set that the task has met before sends nothing.  Of a key that more than CAP documents of a
    flush share one goes to the key's bucket, with spare MARK; all of them go to one of as many
    further buckets, any one, where no keys meet.  So no bucket holds a hot key's documents.
    """

    def flush(held: list) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        key, own, spare = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(key, kind="stable")
        key, own, spare = key[order], own[order], spare[order]
        cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(cut, len(key)))
        bucket = ((key >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int32)
        if (size > CAP).any():
            hot = np.repeat(size > CAP, size)
            head = cut[size > CAP]
            apart = buckets + (ta.mix(key ^ U64(int(own[0]) & (2**64 - 1))) % U64(buckets)).astype(np.int32)
            bucket = np.concatenate([np.where(hot, apart, bucket), bucket[head]]).astype(np.int32)
            key, own = np.concatenate([key, key[head]]), np.concatenate([own, own[head]])
            spare = np.concatenate([spare, np.full(len(head), MARK, np.uint8)])
        order = np.argsort(bucket, kind="stable")
        key, own, spare, bucket = key[order], own[order], spare[order], bucket[order]
        cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        rows = [(int(bucket[a]), b - a, key[a:b].tobytes(), spare[a:b].tobytes(), *_pack(own[a:b])) for a, b in zip(cut, np.append(cut[1:], len(key)), strict=True)]
        for i in range(0, len(rows), 1000):
            b, n, kk, ss, low, off = zip(*rows[i : i + 1000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array(n, pa.int64()), pa.array(kk, pa.binary()), pa.array(ss, pa.binary()), pa.array(low, pa.int64()), pa.array(off, pa.binary())], names=["bucket", "n", "keys", "spare", "low", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count, seen = [], 0, set()
        for batch in batches:
            for lo, hi, data, offs in ta.chunks(batch.column(1)):
                values, bounds = shingle_sets(data, offs, k)
                new = np.zeros(hi - lo, bool)
                for i, h in enumerate(zip(*(x.tolist() for x in _set_hashes(values, bounds)), strict=True)):
                    new[i] = h not in seen
                    seen.add(h)
                if len(seen) > 500_000:
                    seen.clear()
                key, own, spare = keys_of(values, bounds, num, den)
                keep = new[own]
                key, own = key[keep], own[keep]
                held.append((key, batch.column(0).slice(lo, hi - lo).to_numpy(zero_copy_only=False)[own], spare[keep]))
                count += len(key)
                if count > 1_500_000:
                    yield from flush(held)
                    held, count = [], 0
        yield from flush(held)

    return docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(run, "bucket int, n bigint, keys binary, spare binary, low bigint, ids binary")


def _meet(blocks: DataFrame, buckets: int) -> DataFrame:
    """(a, b, many, parts, singles): ids a and b share so many odd and even keys (many 0), or id b is
    in the star of key a, may leave out `parts` odd keys, and more than FEW share the key (many 1)."""

    def run(t: pa.Table) -> pa.Table:
        key = np.concatenate([np.frombuffer(x, U64) for x in t["keys"].to_pylist()])
        spare = np.concatenate([np.frombuffer(x, np.uint8) for x in t["spare"].to_pylist()])
        ids = np.concatenate([_unpack(low, raw, n) for low, raw, n in zip(t["low"].to_pylist(), t["ids"].to_pylist(), t["n"].to_pylist(), strict=True)])
        none = np.zeros(0, np.int64)
        if t["bucket"][0].as_py() >= buckets:
            star, a, b, parts, singles = np.arange(len(key)), none, none, none, none
        else:
            order = np.lexsort((spare, ids, key))
            key, ids, spare = key[order], ids[order], spare[order]
            fresh = np.ones(len(key), bool)
            fresh[1:] = (key[1:] != key[:-1]) | (ids[1:] != ids[:-1])
            # a document that is marked in one flush may be unmarked in another, which sorts first
            marked = spare == MARK
            fresh |= marked
            key, ids, spare, marked = key[fresh], ids[fresh], spare[fresh], marked[fresh]
            cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            size = np.diff(np.append(cut, len(key)))
            big = (size > FEW) | np.logical_or.reduceat(marked, cut)
            pairs, odd = [np.zeros((3, 0), np.int64)], (key & U64(1)).astype(np.int64)
            for m in range(2, FEW + 1):
                g = cut[(size == m) & ~big]
                pairs += [np.stack([ids[g + i], ids[g + j], odd[g]]) for i in range(m) for j in range(i + 1, m)]
            star = np.flatnonzero(np.repeat(big, size) & ~marked)
            a, b, odd = np.concatenate(pairs, axis=1)
            order = np.lexsort((b, a))
            a, b, odd = a[order], b[order], odd[order]
            new = np.ones(len(a), bool)
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            at = np.flatnonzero(new)
            parts = np.add.reduceat(odd, at) if len(at) else odd
            singles = np.diff(np.append(at, len(a))) - parts
            a, b = a[at], b[at]
        ones = np.ones(len(star), np.int64)
        cols = (a, key[star].view(np.int64)), (b, ids[star]), (0 * a, ones), (parts, spare[star].astype(np.int64)), (singles, 0 * ones)
        return pa.table({c: np.concatenate(x) for c, x in zip(("a", "b", "many", "parts", "singles"), cols, strict=True)})

    return blocks.groupBy("bucket").applyInArrow(run, "a bigint, b bigint, many bigint, parts bigint, singles bigint")


def _links(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[j] for x in found], pa.int64()) for j in (0, 1)], names=["a", "b"])


def _by_tile(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """(tile, rows) of sorted batches: the first `width` columns name the tile, binary columns stay buffers."""
    tile, rows = None, []
    for batch in batches:
        cols = [[np.frombuffer(x.as_buffer(), U64) for x in c] if pa.types.is_binary(c.type) else c.to_pylist() for c in batch.columns]
        for r in zip(*cols, strict=True):
            if r[:width] != tile:
                if rows:
                    yield tile, rows
                tile, rows = r[:width], []
            rows.append(r[width:])
    if rows:
        yield tile, rows


def _verify_hubs(rows: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b) links of hubs a with the members of rows(a, chunk, member, doc_id, shingles).

    A chunk is its hub's row, with member 0, and its members.  An exact intersection is a search
    in the hub's sorted array.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (hub, _), block in _by_tile(batches, 2):
            found = []
            hubs, rest = [x[2] for x in block if not x[0]], [x for x in block if x[0]]
            if hubs and rest:
                flat, size = np.concatenate([x[2] for x in rest]), np.array([len(x[2]) for x in rest])
                for h in hubs:
                    hit = h[np.minimum(np.searchsorted(h, flat), len(h) - 1)] == flat
                    both = np.add.reduceat(hit.astype(np.int64), np.cumsum(size) - size)
                    found += [(hub, rest[i][1]) for i in np.flatnonzero(den * both >= num * (len(h) + size - both)).tolist()]
            yield _links(found)

    sorted_rows = rows.select("a", "chunk", "member", "doc_id", "shingles").repartition("a", "chunk").sortWithinPartitions("a", "chunk", "member")
    return sorted_rows.mapInArrow(run, "a bigint, b bigint")


def _bitmaps(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n, bitmap): hashed bitmaps of eight bits or more to a shingle, a power of two wide."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in ta.chunks(batch.column(1)):
                values, bounds = shingle_sets(data, offs, k)
                maps = []
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                    bits = max(64, 1 << (8 * (b - a) - 1).bit_length()) if b > a else 64
                    spot = np.zeros(bits, bool)
                    spot[(values[a:b] >> U64(7)).astype(np.int64) & (bits - 1)] = True
                    maps.append(np.packbits(spot, bitorder="little").tobytes())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(np.diff(bounds)), pa.array(maps, pa.binary())], names=["doc_id", "n", "bitmap"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n bigint, bitmap binary")


def _bounded(pairs: DataFrame, maps: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs(a, b, na, nb) whose bitmaps do not rule the link out.

    A bit of one map that the other lacks is a shingle the other lacks, so the overlap is at
    most a set's size less such bits.  The wider map is folded onto the narrower one.
    """
    side = lambda x: maps.select(F.col("doc_id").alias(x), F.col("bitmap").alias(f"m{x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            need = -(-num * (na + nb) // (num + den))
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column(4), batch.column(5), strict=True)):
                x, y = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
                w = min(len(x), len(y))
                x, y = (np.bitwise_or.reduce(m.reshape(-1, w), axis=0) for m in (x, y))
                most = min(na[i] - int(np.bitwise_count(x & ~y).sum()), nb[i] - int(np.bitwise_count(y & ~x).sum()))
                keep[i] = most >= need[i]
            yield batch.select(["a", "b", "na", "nb"]).filter(pa.array(keep))

    rows = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "ma", "mb")
    return rows.mapInArrow(run, "a bigint, b bigint, na bigint, nb bigint").distinct()


def _read_again(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """docs of the ids, which are broadcast only if they are few."""
    ids = stored(ids.distinct(), "ids")
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", "left_semi")


def _sets(docs: DataFrame, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in ta.chunks(batch.column(1)):
                values, bounds = shingle_sets(data, offs, k)
                raw = values.tobytes()
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array([raw[8 * a : 8 * b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())], names=["doc_id", "shingles"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, shingles binary")


def _few(df: DataFrame) -> DataFrame:
    """df, stored, and broadcast if its rows are few."""
    df = stored(df, "few")
    return F.broadcast(df) if df.count() <= BROADCAST_IDS else df


def _stars(met: DataFrame, of: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The members (key, rep, n) of stars, less the keys that a class may leave out, and (rep, odd, even):
    how many star keys of either kind a class has."""
    rows = met.where("many = 1").select(F.col("a").alias("key"), F.col("b").alias("doc_id"), F.col("parts").alias("spare"))
    rows = stored(rows.join(of, "doc_id").groupBy("key", "rep", "n").agg(F.min("spare").alias("spare")), "members")
    odd = F.col("key").bitwiseAND(F.lit(1)) == 1
    # frequent keys last; any order that all classes share would do
    sizes = _few(rows.groupBy("key").agg(F.count("*").alias("m")).where("m > 1"))
    place = F.row_number().over(Window.partitionBy("rep", odd).orderBy(F.desc("m"), "key"))
    kept = rows.join(sizes, "key").withColumn("place", place).where(F.col("place") > F.col("spare"))
    return stored(kept.select("key", "rep", "n"), "stars"), rows.groupBy("rep").agg(F.count_if(odd).alias("odd"), F.count_if(~odd).alias("even"))


def _hub_rows(pairs: DataFrame) -> DataFrame:
    """(a, chunk, member, doc_id): the pairs(a, b, na, nb) as hubs with chunks of BLOCK members or WEIGHT shingles."""
    chunks = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("nb") / WEIGHT)).cast("int")
    large = _few(pairs.groupBy("a").agg(chunks.alias("chunks")).where("chunks > 1"))
    rows = pairs.join(large, "a", "left").select("a", F.pmod(F.xxhash64("b"), F.coalesce("chunks", F.lit(1))).cast("int").alias("chunk"), "b")
    hubs = rows.select("a", "chunk", F.lit(0).alias("member"), F.col("a").alias("doc_id")).distinct()
    return hubs.unionByName(rows.select("a", "chunk", F.lit(1).alias("member"), F.col("b").alias("doc_id")))


def jaccard_join(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row of docs(doc_id, text).

    Two documents are linked when den * |A and B| >= num * |A or B| over their sets of
    distinct k-word shingles (A-Z lower-cased); component_id is the smallest doc_id reachable
    by links.  Null and empty texts have no shingles and stand alone; a null doc_id has a null
    component.  Rows with the same doc_id are one node.  Other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    spark = docs.sparkSession
    measured = stored(_measure(docs, k), "sets")
    real = measured.where("doc_id is not null and n_shingles > 0")
    classes = real.groupBy("n_shingles", "h1", "h2").agg(F.min("doc_id").alias("rep"))
    of = stored(real.join(classes, ["n_shingles", "h1", "h2"]).select("doc_id", "rep", F.col("n_shingles").alias("n")), "classes")

    # a bucket is about a million keys, a set has about half as many as shingles
    total = measured.agg(F.sum("n_shingles")).first()[0] or 0
    buckets = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), total // 2_000_000)
    met = stored(_meet(_blocks(docs, k, num, den, buckets), buckets), "met")
    stars, left = _stars(met, of)

    pairs = met.where("many = 0").groupBy("a", "b").agg(F.sum("parts").alias("parts"), F.sum("singles").alias("singles"))
    known = of.join(left, "rep", "left").select("doc_id", "rep", "n", F.coalesce("odd", F.lit(0)).alias("odd"), F.coalesce("even", F.lit(0)).alias("even"))
    side = lambda x: known.select(F.col("doc_id").alias(x), F.struct("rep", "n", "odd", "even").alias(f"s{x}"))
    pairs = pairs.join(side("a"), "a").join(side("b"), "b").where("sa.rep <> sb.rep")
    pairs = pairs.select(F.least("sa", "sb").alias("x"), F.greatest("sa", "sb").alias("y"), "parts", "singles")
    pairs = pairs.groupBy(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"), F.col("x.n").alias("na"), F.col("y.n").alias("nb"), F.least("x.odd", "y.odd").alias("odd"), F.least("x.even", "y.even").alias("even")).agg(F.sum("parts").alias("parts"), F.sum("singles").alias("singles"))
    near = F.least("na", "nb") * den >= F.greatest("na", "nb") * num
    # of the keys that a pair shares as many as either has in stars are not counted here
    shared = F.ceil((F.col("na") + F.col("nb")) * num / (num + den))
    enough = (F.col("parts") + F.col("odd") >= needed(num, den)) | (F.col("singles") + F.col("even") >= shared)
    pairs = pairs.where(near & enough).select("a", "b", "na", "nb")
    hubs = _few(stars.groupBy("key").agg(F.min(F.struct("rep", "n")).alias("hub"), F.count("*").alias("m")).where("m > 1").select("key", "hub"))
    spokes = stars.join(hubs, "key").select(F.col("hub.rep").alias("a"), F.col("rep").alias("b"), F.col("hub.n").alias("na"), F.col("n").alias("nb"))
    pairs = stored(pairs.unionByName(spokes.where(near & (F.col("a") != F.col("b")))).distinct(), "candidates")
    dropped(met)

    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).unionByName(stars.select(F.col("rep").alias("doc_id")))
    maps = stored(_bitmaps(_read_again(docs, wanted), k), "bitmaps")
    close = stored(_bounded(pairs, maps, num, den), "pairs")
    dropped(pairs)
    links = _linked(docs, close, k, num, den)
    found = connected_components(links)

    rest = stars.join(found.withColumnRenamed("id", "rep"), "rep", "left").select("key", "rep", "n", F.coalesce("component", "rep").alias("grp"))
    close = stored(_across(rest, maps, num, den), "pairs")
    if not close.isEmpty():
        links = links.unionByName(_linked(docs, close, k, num, den))
        found = connected_components(links)
    dropped(maps, stars)
    root = of.select("doc_id", "rep").distinct().join(found.withColumnRenamed("id", "rep"), "rep", "left").select("doc_id", F.coalesce("component", "rep").alias("root"))
    if not _single(of):
        equal = of.where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
        root = connected_components(links.unionByName(equal)).withColumnRenamed("id", "doc_id").withColumnRenamed("component", "root")
    return measured.join(root, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id"))


def _single(of: DataFrame) -> bool:
    """Whether every doc_id has one class (it can have more if rows repeat an id with other texts)."""
    return of.groupBy("doc_id").agg(F.min("rep").alias("x"), F.max("rep").alias("y")).where("x <> y").isEmpty()


def _linked(docs: DataFrame, close: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(a, b): those of the pairs(a, b, na, nb) that link."""
    rows = stored(_hub_rows(close), "hubs")
    sets = stored(_sets(_read_again(docs, rows.select("doc_id")), k), "shingles")
    links = stored(_verify_hubs(rows.join(sets, "doc_id"), num, den), "links")
    dropped(close, rows, sets)
    return links


def _across(rest: DataFrame, maps: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b, na, nb): pairs of members(key, rep, n, grp) of a key in different groups that bitmaps do not rule out.

    Every member outside a key's largest group is odd.  A tile is TILE members and TILE odd ones of
    one key, which belongs to one size band, so what is sent grows with the members and not with
    their pairs until a key has many tiles of odd ones.
    """
    size = rest.groupBy("key", "grp").agg(F.count("*").alias("m"), F.sum("n").alias("w")).groupBy("key")
    tiles = lambda m, w: F.ceil(F.greatest(m / TILE, w / (TILE << 9), F.lit(1))).cast("int")
    odd = lambda c: F.sum(c) - F.max_by(c, F.struct("m", "grp"))
    keys = size.agg(F.max_by("grp", F.struct("m", "grp")).alias("most"), F.count("*").alias("groups"), tiles(F.sum("m"), F.sum("w")).alias("tm"), tiles(odd("m"), odd("w")).alias("to"))
    rows = rest.join(_few(keys.where("groups > 1").drop("groups")), "key")
    at = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    member = rows.select("key", at("tm").alias("x"), every("to").alias("y"), F.lit(0).alias("odd"), "rep", "grp")
    single = rows.where("grp <> most").select("key", every("tm").alias("x"), at("to").alias("y"), F.lit(1).alias("odd"), "rep", "grp")
    sized = member.unionByName(single).join(maps.withColumnRenamed("doc_id", "rep"), "rep").select("key", "x", "y", "odd", "rep", "grp", "n", "bitmap")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _by_tile(batches, 3):
            odd, ids, group, size, maps = (list(x) for x in zip(*rows, strict=True))
            ids, group, size, odd = (np.array(x, np.int64) for x in (ids, group, size, odd))
            w = min(len(m) for m in maps)
            bits = np.stack([np.bitwise_or.reduce(m.reshape(-1, w), axis=0) for m in maps])
            order = np.flatnonzero(odd == 0)
            order = order[np.argsort(size[order], kind="stable")]
            sorted_size, found = size[order], [np.zeros((4, 0), np.int64)]
            for i in np.flatnonzero(odd).tolist():
                low, high = np.searchsorted(sorted_size, [-(-size[i] * num // den), size[i] * den // num + 1])
                other = order[low:high]
                other = other[group[other] != group[i]]
                mine = size[i] - np.bitwise_count(bits[i] & ~bits[other]).sum(1, dtype=np.int64)
                other = other[mine >= -(-num * (size[i] + size[other]) // (num + den))]
                their = size[other] - np.bitwise_count(bits[other] & ~bits[i]).sum(1, dtype=np.int64)
                other = other[their >= -(-num * (size[i] + size[other]) // (num + den))]
                found.append(np.stack([np.full(len(other), ids[i]), ids[other], np.full(len(other), size[i]), size[other]]))
            a, b, na, nb = np.concatenate(found, axis=1)
            turn = a > b
            cols = np.where(turn, b, a), np.where(turn, a, b), np.where(turn, nb, na), np.where(turn, na, nb)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["a", "b", "na", "nb"])

    sized = sized.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")
    return sized.mapInArrow(run, "a bigint, b bigint, na bigint, nb bigint").distinct()
