"""Periodic runs of words, by the linear tandem-repeat method of Gusfield and Stoye.

A tandem repeat is a stretch of words that is some words twice over; a run is a maximal stretch
with a period of at most half its length, so all tandem repeats of one period that follow each
other by one word are one run.  The method has three phases:

1. LZ blocks cut the text; each block is the longest piece that also starts earlier.  Common
   extensions to either side of a block's two ends give pairs (start, period) that cover the
   leftmost occurrence of every tandem repeat.
2. From a pair's place in the suffix tree suffix links are walked: a link drops the first word,
   and the walk goes on while that word follows again.  This marks the place of every different
   tandem repeat, the vocabulary.  The tree is held as a suffix array with the ranks of all
   prefixes whose length is a power of two: a place in it is a range of the array, a link leads
   to the range of the next text position, and two positions are compared by a rank for each power.
3. The suffixes below a marked place are the occurrences of its repeat.  Those of one period that
   follow each other merge into runs.

Words with equal 64-bit hashes count as equal.  A run of 12 words or more is covered by 6-word
windows that occur twice in its text, so only stretches covered by such windows are looked at; most
texts have none.  Documents are independent: nothing is shuffled, and a lost task is run again.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textarrays as ta

U64 = np.uint64
#: The least length of a run, and the windows that cover any run of that length.
LEAST, GRAM = 12, 6

Rewrite = Callable[[list, np.ndarray], np.ndarray]


class Suffixes:
    """A suffix array with the ranks of prefixes of 1, 2, 4, ... words.

    No two suffixes may be equal for ever: the text ends with, and is divided by, values found once.
    """

    def __init__(self, words: np.ndarray):
        n = len(words)
        rank = np.unique(words, return_inverse=True)[1].astype(np.int64)
        self.levels, width = [], 1
        while True:
            self.levels.append(np.append(rank, -1).astype(np.int32))
            if int(rank.max()) == n - 1:
                break
            after = np.zeros(n, np.int64)
            after[: n - width] = rank[width:] + 1
            rank = np.unique(rank * (n + 1) + after, return_inverse=True)[1]
            width *= 2
        self.n, self.rank = n, rank
        self.order = np.empty(n, np.int64)
        self.order[rank] = np.arange(n)

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i and from j on are equal; i and j differ and are below n + 1."""
        out = np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            out += (level[i + out] == level[j + out]).astype(np.int64) << k
        return out

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words up to i and up to j, these included, are equal; -1 is before the first."""
        out = np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            a, b = i - out - (1 << k) + 1, j - out - (1 << k) + 1
            fit = (a >= 0) & (b >= 0)
            out += (fit & (self.levels[k][np.where(fit, a, 0)] == self.levels[k][np.where(fit, b, 0)])).astype(np.int64) << k
        return out

    def place(self, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of the suffix array whose suffixes begin with the `size` words at `at`."""
        low, high = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
        power = np.int64(np.floor(np.log2(size)))
        for k in np.unique(power).tolist():
            who = np.flatnonzero(power == k)
            level, x, rest = self.levels[k], at[who], size[who] - (1 << k)
            ends = np.append(0, np.cumsum(np.bincount(level[:-1])))
            same = lambda r: level[np.minimum(self.order[r] + rest, self.n)] == level[x + rest]  # noqa: B023, E731
            a, b = ends[level[x]].copy(), self.rank[x].copy()
            while (a < b).any():  # the first that begins so
                mid = (a + b) // 2
                ok = same(mid)
                a, b = np.where(ok, a, np.minimum(mid + 1, b)), np.where(ok, mid, b)
            low[who] = a
            a, b = self.rank[x].copy(), ends[level[x] + 1] - 1
            while (a < b).any():  # the last
                mid = (a + b + 1) // 2
                ok = same(mid)
                a, b = np.where(ok, mid, a), np.where(ok, b, np.maximum(mid - 1, a))
            high[who] = a + 1
        return low, high


def lz_blocks(tree: Suffixes) -> np.ndarray:
    """The starts of the LZ blocks, and the end: each block is the longest prefix of the rest that also starts earlier, or one new word."""
    order = tree.order.tolist()
    beside = []
    for line in (order, order[::-1]):  # in the array, the nearest suffix on either side that starts earlier
        near, stack = [-1] * tree.n, []
        for s in line:
            while stack and stack[-1] > s:
                stack.pop()
            if stack:
                near[s] = stack[-1]
            stack.append(s)
        beside.append(np.array(near, np.int64))
    longest = np.zeros(tree.n, np.int64)
    for near in beside:
        has = np.flatnonzero(near >= 0)
        longest[has] = np.maximum(longest[has], tree.forward(has, near[has]))
    step, starts, i = np.maximum(longest, 1).tolist(), [], 0
    while i < tree.n:
        starts.append(i)
        i += step[i]
    return np.array([*starts, tree.n], np.int64)


def _upto(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, 1..count of that row) for every row."""
    row = np.repeat(np.arange(len(count)), count)
    return row, np.arange(1, len(row) + 1) - np.repeat(np.cumsum(count) - count, count)


def covering_pairs(tree: Suffixes, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of tandem repeats; every tandem repeat's leftmost occurrence follows one of them by shifts to the right."""
    word, n = tree.levels[0], tree.n
    h, end = blocks[:-1], blocks[1:]
    after = np.append(blocks[2:], n)
    # over a block's end: the second half holds the first word after the block
    row, k = _upto(end - h)
    on = end[row] < n
    row, k = row[on], k[on]
    on = word[end[row]] == word[end[row] - k]
    row, k = row[on], k[on]
    q = end[row] - k
    ahead, behind = tree.forward(end[row], q), tree.backward(end[row] - 1, q - 1)
    on = ahead + behind >= k
    found = [(np.maximum(q - behind, q - k + 1)[on], k[on])]
    # over a block's start: the first half holds it
    row, k = _upto(after - h - 1)
    q = h[row] + k
    on = (h[row] > 0) & (word[h[row]] == word[q])
    on[on] = word[h[row[on]] - 1] == word[q[on] - 1]
    row, k, q = row[on], k[on], q[on]
    ahead, behind = tree.forward(h[row], q), tree.backward(h[row] - 1, q - 1)
    start = np.maximum(h[row] - behind, h[row] - k + 1)
    on = (ahead + behind >= k) & (start + k <= end[row])
    found.append((start[on], k[on]))
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def primitive(tree: Suffixes, start: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which repeats' halves are not themselves some words several times over."""
    out, rest = np.ones(len(start), bool), period.copy()
    if not len(start):
        return out
    least = np.arange(int(period.max()) + 1)  # the smallest prime factor
    for p in range(2, int(len(least) ** 0.5) + 1):
        if least[p] == p:
            part = least[p * p :: p]
            part[part == np.arange(p * p, len(least), p)] = p
    while (at := np.flatnonzero(rest > 1)).size:
        factor = least[rest[at]]
        part = period[at] // factor
        out[at[tree.forward(start[at], start[at] + part) >= 2 * period[at] - part]] = False
        rest[at] //= factor
    return out


def runs(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs of a text that ends with, and is divided by, values found once."""
    none = np.zeros(0, np.int64)
    if len(words) < 3:
        return none, none, none
    tree = Suffixes(words)
    start, period = covering_pairs(tree, lz_blocks(tree))
    keep = primitive(tree, start, period)
    start, period = start[keep], period[keep]
    if not len(start):
        return none, none, none
    # a walk of suffix links: as long as the word that a link drops follows again, once around at most
    length = np.minimum(tree.forward(start, start + period) - period + 1, period)
    row, step = _upto(length)
    key = np.unique(period[row] * (tree.n + 1) + start[row] + step - 1)
    period, start = key // (tree.n + 1), key % (tree.n + 1)
    low, high = tree.place(start, 2 * period)
    marked, first = np.unique(period * (tree.n + 1) + low, return_index=True)  # a place is marked once
    row, step = _upto((high - low)[first])
    key = np.sort(np.repeat(period[first], (high - low)[first]) * (tree.n + 1) + tree.order[low[first][row] + step - 1])
    new = np.append(True, np.diff(key) != 1)
    opens, closes = key[new], key[np.append(np.flatnonzero(new)[1:] - 1, len(key) - 1)]
    period = opens // (tree.n + 1)
    return opens % (tree.n + 1), closes % (tree.n + 1) + 2 * period, period


def _stretches(hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the stretches of LEAST words or more, within documents, that repeated windows cover."""
    none = np.zeros(0, np.int64)
    if len(hashes) < LEAST:
        return none, none
    wins = ta.window_hash(hashes, GRAM, 5)
    at = np.flatnonzero(doc[: len(wins)] == doc[GRAM - 1 :])
    with np.errstate(over="ignore"):
        key = ta.mix(wins[at] + doc[at].astype(U64) * U64(0x9E3779B97F4A7C15))
    ranked = np.sort(key)
    twice = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])
    if not len(twice):
        return none, none
    again = at[twice[np.minimum(np.searchsorted(twice, key), len(twice) - 1)] == key]
    inside = ta.covered(again, GRAM, len(hashes))
    edge = np.append(True, doc[1:] != doc[:-1])
    first = inside & (np.append(True, ~inside[:-1]) | edge)
    last = inside & (np.append(~inside[1:], True) | np.append(edge[1:], True))
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    long = end - start >= LEAST
    return start[long], end[long]


def document_runs(hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period), as word numbers of the chunk, of all runs of LEAST words or more inside its documents."""
    begin, end = _stretches(hashes, doc)
    if not len(begin):
        return begin, begin, begin
    row, step = _upto(end - begin)
    # each stretch is followed by a value of its own
    place = np.arange(len(row)) + row
    joined = np.empty(len(row) + len(begin), np.int64)
    joined[place] = np.unique(hashes[begin[row] + step - 1], return_inverse=True)[1]
    stops = np.cumsum(end - begin) + np.arange(len(begin))
    joined[stops] = len(row) + np.arange(len(begin))
    home = np.empty(len(joined), np.int64)
    home[place] = begin[row] + step - 1
    s, e, period = runs(joined)
    long = e - s >= LEAST
    s, e, period = home[s[long]], home[e[long] - 1] + 1, period[long]
    order = np.lexsort((period, s))
    return s[order], e[order], period[order]


def planted(ids: list, n_words: np.ndarray) -> np.ndarray:
    """The word that stands at each place if some documents are made periodic, by the checksum of their ids.

    With h the CRC-32 of the decimal id and g = h // 10: where h % 10 = 0, words from a = g % n on
    repeat with a period of 1 + (n - a) // (3 + g % 8).  A null id changes nothing.
    """
    base = np.cumsum(n_words) - n_words
    out = np.arange(int(n_words.sum()))
    for i, name in enumerate(ids):
        n = int(n_words[i])
        h = 1 if name is None else zlib.crc32(str(name).encode())
        if n and h % 10 == 0:
            g = h // 10
            a = g % n
            tail = np.arange(n - a)
            out[base[i] + a : base[i] + n] = base[i] + a + tail % (1 + (n - a) // (3 + g % 8))
    return out


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def tandem_runs(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",), rewrite: Rewrite | None = None) -> DataFrame:
    """The carried columns, n_words, runs (start, length, period; by start, then period) and the collapsed text of each row.

    Words are maximal runs of bytes other than space and 0x09-0x0D; a run is at least 12 words and two
    periods long, has its smallest period, and cannot be extended.  Collapsed keeps the words that no
    run holds after its first period, joined by one space.  A null text has no words and counts as
    empty, as does an empty one: no runs and an empty collapsed text.  Texts are looked at whole; a
    text's repeated parts take some 200 bytes a word while they are.  Rows that repeat are treated alike, each
    on its own; columns of docs that are not carried are ignored, and the carried ones may have any name.
    `rewrite` says, from the first carried column's values and the word counts of some rows, which
    of their words stands at each place.
    """
    kept = docs.select(*[docs[c].alias(f"_{i}") for i, c in enumerate(carry)], docs["text"].alias("_text"))
    kinds = ", ".join(f"_{i} {f.dataType.simpleString()}" for i, f in enumerate(kept.schema.fields[:-1]))
    schema = f"{kinds}, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in ta.chunks(batch.column(len(carry))):
                cols = [batch.column(i).slice(lo, hi - lo) for i in range(len(carry))]
                starts, ends, doc = ta.words(data, offs)
                hashes, n_words = ta.span_hash(data, starts, ends), np.bincount(doc, minlength=hi - lo)
                source = rewrite(cols[0].to_pylist(), n_words) if rewrite else None
                s, e, period = document_runs(hashes if source is None else hashes[source], doc)
                drop = np.zeros(len(doc), bool)
                if len(s):
                    step = np.bincount(s + period, minlength=len(doc) + 1) - np.bincount(e, minlength=len(doc) + 1)
                    drop = np.cumsum(step[: len(doc)]) > 0
                base, raw, texts = np.cumsum(n_words) - n_words, data.tobytes(), []
                changed = np.bincount(doc[drop], minlength=hi - lo) > 0
                if source is not None:
                    changed |= np.bincount(doc[source != np.arange(len(source))], minlength=hi - lo) > 0
                for i in range(hi - lo):
                    w = raw[offs[i] : offs[i + 1]].split()
                    if changed[i]:
                        span = slice(int(base[i]), int(base[i] + n_words[i]))
                        if source is not None:
                            w = [w[j] for j in (source[span] - base[i]).tolist()]
                        w = compress(w, (~drop[span]).tolist())
                    texts.append(b" ".join(w))
                of = doc[s] if len(s) else np.zeros(0, np.int64)
                flat = pa.StructArray.from_arrays([pa.array(s - base[of]), pa.array(e - s), pa.array(period)], fields=list(_RUN))
                cuts = pa.array(np.append(0, np.cumsum(np.bincount(of, minlength=hi - lo))).astype(np.int32))
                texts = pa.array([x.decode("utf-8", "replace") for x in texts], pa.string())
                yield pa.RecordBatch.from_arrays([*cols, pa.array(n_words), pa.ListArray.from_arrays(cuts, flat), texts], names=[*[f"_{i}" for i in range(len(carry))], "n_words", "runs", "collapsed"])

    out = kept.mapInArrow(run, schema)
    return out.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(carry)], "n_words", "runs", "collapsed")


def run_digests(found: DataFrame) -> DataFrame:
    """The longest run of each row, of equals the first and then the shortest period, and digests of its runs and collapsed text."""
    best = F.aggregate("runs", F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>"), lambda a, x: F.when(a.isNull() | (x["length"] > a["length"]), x).otherwise(a))
    lines = F.concat_ws("", F.transform("runs", lambda x: F.concat(F.concat_ws(",", x["start"].cast("string"), x["length"].cast("string"), x["period"].cast("string")), F.lit("\n"))))
    out = found.withColumn("best", best).select("*", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period")
    return out.select(
        "doc_id", "n_words", "n_runs", "start", "length", "period",
        F.floor(F.lit(1000) * F.col("length") / F.col("period")).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
