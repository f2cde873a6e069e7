"""Vectorised text primitives shared by the operators' Arrow stages.

A batch of texts is looked at as one byte buffer with document offsets, so words, lines
and word windows of thousands of documents are found and hashed by a few numpy passes.
Words are maximal runs of bytes other than space and 0x09-0x0D; these bytes never occur
inside a multi-byte UTF-8 character, so byte runs and character runs agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (the public splitmix64 constants)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def stream(n: int, seed: int) -> np.ndarray:
    """n pseudo-random odd 64-bit multipliers."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=U64) + U64(seed) * U64(0x9E3779B97F4A7C15))) | U64(1)


#: Bytes looked at at a time, and the longest span that the vectorised hash takes.
SEGMENT, LONG = 1 << 20, 1 << 12
_TABLES: dict[int, np.ndarray] = {}


def _table(seed: int) -> np.ndarray:
    if seed not in _TABLES:
        _TABLES[seed] = stream(LONG, seed)
    return _TABLES[seed]


def chunks(texts: pa.Array, limit: int = 384 << 10) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) for runs of rows of about `limit` bytes.

    A null counts as an empty text.  A text longer than the limit is a run of its own.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null(b"" if pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type) else "")
    if not len(texts):
        return
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offs, data = texts.buffers()
    offs = np.frombuffer(offs, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        yield lo, hi, data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


def per_doc(mask: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """How many bytes of each document are set in the mask."""
    if len(mask) > SEGMENT:
        return np.array([np.count_nonzero(mask[a:b]) for a, b in zip(offs[:-1], offs[1:], strict=True)])
    return np.diff(np.searchsorted(np.flatnonzero(mask), offs))


def _runs(inside: Callable[[np.ndarray], np.ndarray], data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of every run of bytes that are inside, in order; a run ends with its document."""
    n, starts, ends = len(data), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    some = offs[:-1] < offs[1:]
    begin, final = offs[:-1][some], offs[1:][some] - 1
    for lo in range(0, n, SEGMENT):
        hi = min(n, lo + SEGMENT)
        a, b = max(0, lo - 1), min(n, hi + 1)  # a byte more on either side
        body = inside(data[a:b])
        first, last = body.copy(), body.copy()
        first[1:] &= ~body[:-1]
        last[:-1] &= ~body[1:]
        for marks, at in ((first, begin), (last, final)):
            at = at[np.searchsorted(at, a) : np.searchsorted(at, b)] - a
            marks[at] = body[at]
        starts.append(np.flatnonzero(first[lo - a : hi - a]) + lo)
        ends.append(np.flatnonzero(last[lo - a : hi - a]) + lo + 1)
    starts, ends = np.concatenate(starts), np.concatenate(ends)
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of every word, in order."""
    return _runs(lambda x: ~SPACE[x], data, offs)


def lines(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of every line that is not empty, split at \\n."""
    return _runs(lambda x: x != 10, data, offs)


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 1) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; spans are not empty.

    Spans are hashed some SEGMENT bytes at a time, one longer than LONG on its own.
    """
    size = ends - starts
    if len(size) and int(size.max()) > LONG:
        out, long = np.zeros(len(size), U64), size > LONG
        out[~long] = span_hash(data, starts[~long], ends[~long], seed)
        key = seed.to_bytes(8, "little")
        for i in np.flatnonzero(long).tolist():
            out[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]], digest_size=8, key=key).digest(), "little")
        return out
    total = np.cumsum(size)
    if not len(size) or total[-1] <= SEGMENT:
        return _short_hash(data, starts, ends, seed)
    cut = np.searchsorted(total, np.arange(0, int(total[-1]), SEGMENT)).tolist() + [len(size)]
    return np.concatenate([_short_hash(data, starts[a:b], ends[a:b], seed) for a, b in zip(cut[:-1], cut[1:], strict=True)])


def _short_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, U64)
    size = ends - starts
    base = np.cumsum(size) - size
    place = np.arange(int(base[-1] + size[-1]), dtype=np.int64) - np.repeat(base, size)
    body = data[place + np.repeat(starts, size)]
    with np.errstate(over="ignore"):
        total = np.add.reduceat((body.astype(U64) + U64(1)) * _table(seed)[place], base)
        return mix(total + size.astype(U64) * U64(0xD6E8FEB86659FD93))


def window_hash(hashes: np.ndarray, k: int, seed: int = 7) -> np.ndarray:
    """A hash of each k consecutive values; as many as there are windows in the whole array."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = np.zeros(n, U64)
    with np.errstate(over="ignore"):
        for j, c in enumerate(stream(k, seed)):
            out += hashes[j : j + n] * c
        return mix(out)


def covered(starts: np.ndarray, width: int | np.ndarray, n: int) -> np.ndarray:
    """Which of n positions lie in a window that begins at one of the starts."""
    step = np.bincount(starts, minlength=n + 1) - np.bincount(starts + width, minlength=n + 1)
    return np.cumsum(step[:n]) > 0


#: Letters and digits of ASCII, and every byte of other characters.
TERM = np.zeros(256, bool)
TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def terms(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of every run of letters, digits and characters beyond ASCII, in order."""
    return _runs(lambda x: TERM[x], data, offs)
