"""Token counts of a byte-level BPE by a two-tier lookup on the map side.

A text falls into units, a word with the one space before it, whose token counts do not
depend on their neighbours.  The first tier is a compact hash table of the token counts of
the documents' frequent units, broadcast to the workers; the second is a cache in each
worker, which asks the tokenizer about a unit once.  The frequent units are found by one
sketch a task over all texts, of a fixed number of counters, that is merged in a tree: a
sketch holds hashes, counts and token counts, so no unit and no text is ever shuffled.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import textarrays as ta

U64 = np.uint64
#: Mixed into a unit's hash if a space belongs to it.
_SPACED = U64(0x5851F42D4C957F2D)
#: Counters of a sketch and entries of the first tier: 20 bytes each.
COUNTERS = 1 << 15
#: Sketches that one task, or at the end the driver, merges.
FAN_IN = 64
#: Units of more bytes are left to the worker caches.
UNIT_BYTES = 64


@lru_cache(2)
def tokenizer(path: str):
    """The tokenizer of a file, read once a process."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def token_lengths(path: str, texts: list[str]) -> list[int]:
    return [len(x.ids) for x in tokenizer(path).encode_batch(texts, add_special_tokens=False)]


class UnitTable:
    """An open-addressing table of unit hashes and token counts in two arrays."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        size = 1 << max(4, int(2 * len(keys)).bit_length())
        self.keys, self.counts, self.probes = np.zeros(size, U64), np.zeros(size, np.int32), 1
        for k, c in zip(keys.tolist(), counts.tolist(), strict=True):
            at, tries = k & (size - 1), 1
            while self.counts[at] and int(self.keys[at]) != k:
                at, tries = (at + 1) & (size - 1), tries + 1
            self.keys[at], self.counts[at], self.probes = k, c, max(self.probes, tries)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The counts, 0 where a key is absent."""
        low = U64(len(self.keys) - 1)
        at = (keys & low).astype(np.int64)
        out = np.where(self.keys[at] == keys, self.counts[at], 0)
        todo = np.flatnonzero((out == 0) & (self.counts[at] > 0))
        for _ in range(self.probes - 1):
            if not len(todo):
                break
            at[todo] = (at[todo] + 1) & int(low)
            hit = self.keys[at[todo]] == keys[todo]
            out[todo[hit]] = self.counts[at[todo[hit]]]
            todo = todo[~hit & (self.counts[at[todo]] > 0)]
        return out


def units(data: np.ndarray, offs: np.ndarray):
    """(starts, ends, documents, hashes, with space) of a chunk's words as units."""
    starts, ends, doc = ta.words(data, offs)
    spaced = np.zeros(len(starts), bool)
    later = starts > offs[doc]
    spaced[later] = data[starts[later] - 1] == 0x20
    hashes = ta.span_hash(data, starts, ends, 5)
    hashes[spaced] = ta.mix(hashes[spaced] ^ _SPACED)
    return starts, ends, doc, hashes, spaced


def odd_docs(data: np.ndarray, offs: np.ndarray, specials: tuple[bytes, ...]) -> np.ndarray:
    """Documents with white space outside ASCII or with a special token's string.

    There units may depend on their neighbours, so the tokenizer gets such a text whole.
    """
    lead = np.flatnonzero((data == 0xC2) | (data == 0xE1) | (data == 0xE2) | (data == 0xE3))
    a, b, c = (data[np.minimum(lead + i, len(data) - 1)] for i in range(3)) if len(lead) else (data[:0],) * 3
    space = (a == 0xC2) & ((b == 0x85) | (b == 0xA0)) | (a == 0xE1) & (b == 0x9A) & (c == 0x80) | (a == 0xE3) & (b == 0x80) & (c == 0x80)
    space |= (a == 0xE2) & ((b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)) | (b == 0x81) & (c == 0x9F))
    found = [lead[space]]
    raw = data.tobytes()
    for s in specials:
        at = raw.find(s)
        while at >= 0:
            found.append(np.array([at]))
            at = raw.find(s, at + 1)
    return np.unique(np.searchsorted(offs, np.concatenate(found), "right") - 1)


class Counter:
    """Counts tokens of chunks of texts; lives in a worker, with a bounded cache."""

    CACHE = 2_000_000

    def __init__(self, path: str, table: UnitTable):
        self.specials = tuple(t.content.encode() for t in tokenizer(path).get_added_tokens_decoder().values())
        self.path, self.table, self.cache, self.runs = path, table, {}, {}

    def lengths(self, texts: list[str]) -> list[int]:
        return token_lengths(self.path, texts)

    def count(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        n = len(offs) - 1
        starts, ends, doc, hashes, spaced = units(data, offs)
        got = self.table.get(hashes)
        miss = np.flatnonzero(got == 0)
        if len(miss):
            keys, where, back = np.unique(hashes[miss], return_index=True, return_inverse=True)
            raw, cache = data.tobytes(), self.cache
            found = [cache.get(k, 0) for k in keys.tolist()]
            new = [i for i, x in enumerate(found) if not x]
            at = miss[where[new]]
            asked = [(" " if s else "") + raw[a:b].decode("utf-8", "replace") for a, b, s in zip(starts[at].tolist(), ends[at].tolist(), spaced[at].tolist(), strict=True)]
            if len(cache) + len(new) > self.CACHE:
                cache.clear()
            for i, x in zip(new, self.lengths(asked), strict=True):
                found[i] = cache[int(keys[i])] = x
            got[miss] = np.array(found, np.int64)[back]
        total = np.bincount(doc, weights=got, minlength=n).astype(np.int64)
        self._spaces(data, offs, starts, ends, doc, total)
        for i in odd_docs(data, offs, self.specials).tolist():
            total[i] = self.lengths([data[offs[i] : offs[i + 1]].tobytes().decode("utf-8", "replace")])[0]
        return total

    def _spaces(self, data, offs, starts, ends, doc, total) -> None:
        """Adds the tokens of white space that belongs to no unit.

        Of a run before a word all but the last character form a unit of their own, and so
        does the last one unless it is a space; a run at a text's end is one unit.
        """
        n = len(offs) - 1
        first = np.ones(len(starts), bool)
        first[1:] = doc[1:] != doc[:-1]
        begin = np.where(first, offs[doc], np.concatenate([[0], ends[:-1]]) if len(ends) else 0)
        gap = starts - begin
        alone = np.flatnonzero((gap >= 1) & (data[np.maximum(starts - 1, 0)] != 0x20))
        np.add.at(total, doc[alone], 1)  # every byte is in the vocabulary
        tail = np.array(offs[:-1], copy=True)
        tail[doc] = ends  # of a document's words the last one stays
        long, rest = np.flatnonzero(gap >= 2), np.flatnonzero(tail < offs[1:])
        spans = list(zip(doc[long].tolist(), begin[long].tolist(), (starts[long] - 1).tolist(), strict=True))
        spans += list(zip(rest.tolist(), tail[rest].tolist(), offs[1:][rest].tolist(), strict=True))
        for d, a, b in spans:
            run = data[a:b].tobytes()
            if run not in self.runs:
                if len(self.runs) > 100_000:
                    self.runs.clear()
                self.runs[run] = self.lengths([run.decode()])[0]
            total[d] += self.runs[run]
        assert len(total) == n


class Sketch:
    """The frequent hashes of a stream, by a fixed number of counters.

    Where more hashes are counted than there are counters, the count of the first that has to
    go is taken off all of them.  A hash that makes up more than one part in (counters + 1)
    of the stream therefore stays, also when sketches of parts are merged.
    """

    def __init__(self, counters: int):
        self.counters, self.keys, self.counts = counters, np.zeros(0, U64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        both, back = np.unique(np.concatenate([self.keys, keys]), return_inverse=True)
        n = np.bincount(back, weights=np.concatenate([self.counts, counts]), minlength=len(both)).astype(np.int64)
        if len(both) > self.counters:
            n -= np.partition(n, len(n) - self.counters - 1)[len(n) - self.counters - 1]
            both, n = both[n > 0], n[n > 0]
        self.keys, self.counts = both, n


def _sketch_of(texts: Iterator[pa.Array], path: str, counters: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, counts, token counts) of the frequent units of a task's texts."""
    found, names = Sketch(counters), {}
    for array in texts:
        for _, _, data, offs in ta.chunks(array):
            starts, ends, doc, hashes, spaced = units(data, offs)
            odd = np.isin(doc, odd_docs(data, offs, ()))  # their units do not stand alone
            at = np.flatnonzero((ends - starts <= UNIT_BYTES) & ~odd)
            keys, first, n = np.unique(hashes[at], return_index=True, return_counts=True)
            found.add(keys, n)
            where = at[first[np.isin(keys, found.keys, assume_unique=True)]]
            raw = data.tobytes()
            for k, a, b, sp in zip(hashes[where].tolist(), starts[where].tolist(), ends[where].tolist(), spaced[where].tolist(), strict=True):
                if k not in names:
                    names[k] = raw[a - sp : b]
            if len(names) > 2 * counters:
                names = {k: names[k] for k in found.keys.tolist()}
    lengths = token_lengths(path, [names[k].decode("utf-8", "replace") for k in found.keys.tolist()])
    return found.keys, found.counts, np.array(lengths, np.int32)


def _merged(parts: Iterator[tuple[bytes, bytes, bytes]], counters: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One sketch of many; equal hashes have equal token counts."""
    found, keys, lengths = Sketch(counters), np.zeros(0, U64), np.zeros(0, np.int32)
    for k, n, c in parts:
        k = np.frombuffer(k, U64)
        found.add(k, np.frombuffer(n, np.int64))
        keys, first = np.unique(np.concatenate([keys, k]), return_index=True)
        lengths = np.concatenate([lengths, np.frombuffer(c, np.int32)])[first]
        stays = np.isin(keys, found.keys, assume_unique=True)
        keys, lengths = keys[stays], lengths[stays]
    return found.keys, found.counts, lengths


def frequent_units(docs: DataFrame, path: str, text: str = "text", counters: int = COUNTERS) -> UnitTable:
    """The first tier: token counts of the frequent units of all texts.

    Every text is read; each task keeps `counters` hashes.  Sketches are merged by FAN_IN until
    at most so many are left, which the driver merges: its part does not grow with the texts.
    """
    schema = "keys binary, counts binary, lengths binary"

    def row(sketch: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in sketch], names=["keys", "counts", "lengths"])

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield row(_sketch_of((b.column(0) for b in batches), path, counters))

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield row(_merged((tuple(c[i].as_py() for c in b.columns) for b in batches for i in range(b.num_rows)), counters))

    texts = docs.select(docs[text].alias("__text"))
    left, parts = texts.rdd.getNumPartitions(), texts.mapInArrow(sketched, schema)
    while left > FAN_IN:
        left = -(-left // FAN_IN)
        parts = parts.repartition(left).mapInArrow(merged, schema)
    keys, _, lengths = _merged(((bytes(r.keys), bytes(r.counts), bytes(r.lengths)) for r in parts.collect()), counters)  # FAN_IN rows at most
    return UnitTable(keys, lengths)


def build_table(path: str, frequent: list[str]) -> UnitTable:
    """A first tier of given units, one word each, with or without a space before it."""
    raw = [u.encode() for u in frequent if u.strip(" ")]
    if not raw:
        return UnitTable(np.zeros(0, U64), np.zeros(0, np.int32))
    counts = token_lengths(path, [u.decode() for u in raw])
    data = np.frombuffer(b"".join(raw), np.uint8)
    offs = np.cumsum([0] + [len(u) for u in raw])
    starts, ends, doc, hashes, spaced = units(data, offs)
    # one word that fills the text but for the one space that is its own
    size = np.array([len(u) for u in raw])
    keep = (ends - starts + spaced == size[doc]) & ~np.isin(doc, odd_docs(data, offs, ()))
    return UnitTable(hashes[keep], np.array(counts, np.int32)[doc[keep]])


def token_counts(docs: DataFrame, path: str, text: str = "text", carry: tuple[str, ...] = ("doc_id",), frequent: list[str] | None = None) -> DataFrame:
    """The carried columns, n_bytes (UTF-8) and n_tokens of each row of docs.

    `path` names a tokenizers file with byte-level BPE.  A null text counts as empty: no
    bytes and no tokens.  Texts of any length are counted whole; repeated rows stay; other
    columns of docs are ignored.  `frequent` are the texts of the first tier; unless given, the
    documents' own frequent units are found at once, by a job over all texts.  They decide which
    tier answers, never a result.
    """
    tier = frequent_units(docs, path, text) if frequent is None else build_table(path, frequent)
    table = docs.sparkSession.sparkContext.broadcast(tier)
    out = docs.select(*[docs[c] for c in carry], docs[text].alias("__text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema.fields[:-1]] + ["n_bytes bigint", "n_tokens bigint"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path, table.value)
        for batch in batches:
            for lo, hi, data, offs in ta.chunks(batch.column(batch.num_columns - 1)):
                cols = [batch.column(i).slice(lo, hi - lo) for i in range(len(carry))]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(np.diff(offs)), pa.array(counter.count(data, offs))], names=[*carry, "n_bytes", "n_tokens"])

    return out.mapInArrow(run, schema)
