"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word is the bag of its hashed character n-grams and of itself, so an unseen misspelling
shares most of its vectors with the word it comes from.  SPAN consecutive words are averaged
(all of them, if a text has fewer), and a softmax over two classes reads the average; a text
scores as its highest span does, so that an insult weighs the same in a long text as in a
short one.  Embeddings and softmax are trained jointly in numpy on a bounded sample of
labelled rows, first on the averages of whole texts and then on each text's highest span;
then a text of any length is scored in tasks: averaging and softmax being linear, a word
enters as one number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textarrays as ta

U64 = np.uint64
#: Character n-grams of a word between its borders, and how many hashed vectors there are.
GRAMS, BUCKETS, DIM = (3, 4, 5), 1 << 16, 16
#: Labelled rows to train on at most: this many of each class, by a hash of the doc_id.
SAMPLE = 1500
#: Texts longer than this many bytes are not trained on, so that the driver gets a bounded sample.
SAMPLE_BYTES = 100_000
#: Consecutive words that are averaged.
SPAN = 6
_EDGE = np.frombuffer(b"\x01", np.uint8)


def word_buckets(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, word of each) of the given words of a lower-cased byte buffer."""
    size = ends - starts + 2
    base = np.cumsum(size) - size
    n = int(size.sum())
    body = np.full(n, 1, np.uint8)
    inner = np.arange(int((ends - starts).sum())) - np.repeat(base - 2 * np.arange(len(size)), ends - starts)
    body[inner + np.repeat(base + 1, ends - starts)] = data[inner + np.repeat(starts, ends - starts)]
    owner = np.repeat(np.arange(len(size)), size)
    wide = ta.stream(256, 21)[body]
    got, own = [ta.span_hash(data, starts, ends, 23)], [np.arange(len(size))]
    for k in GRAMS:
        h = ta.window_hash(wide, k, 30 + k)
        ok = owner[: len(h)] == owner[k - 1 :] if len(h) else np.zeros(0, bool)
        got.append(h[ok])
        own.append(owner[: len(h)][ok])
    return (np.concatenate(got) % U64(BUCKETS)).astype(np.int64), np.concatenate(own)


def bag(data: np.ndarray, offs: np.ndarray):
    """(lower-cased bytes; hash, start and end of each distinct word; the distinct word of each word;
    first word and length of each span, document of each span)."""
    data = ta.LOWER[data]
    starts, ends, doc = ta.words(data, offs)
    keys, where, back = np.unique(ta.span_hash(data, starts, ends, 17), return_index=True, return_inverse=True)
    n = len(offs) - 1
    count = np.bincount(doc, minlength=n)
    spans = np.maximum(1, count - SPAN + 1)
    of = np.repeat(np.arange(n), spans)
    first = np.arange(len(of)) - np.repeat(np.cumsum(spans) - spans, spans) + np.repeat(np.cumsum(count) - count, spans)
    return data, keys, starts[where], ends[where], back, first, np.minimum(SPAN, count)[of], of


def span_means(values: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The mean of each span of values, 0 for an empty one, whatever stands around it."""
    padded, total = np.concatenate([values, np.zeros(SPAN)]), np.zeros(len(first))
    for j in range(SPAN):
        total += np.where(j < size, padded[first + j], 0.0)
    return total / np.maximum(1, size)


class Model:
    """One number per bucket, and a bias: what embeddings and softmax come to for class 1."""

    def __init__(self, weight: np.ndarray, bias: float):
        self.weight, self.bias = weight, bias


def train(texts: list[str], labels: list[int], whole: int = 8, epochs: int = 16, rate: float = 0.3, seed: int = 5) -> Model:
    """Trains embeddings and softmax jointly by AdaGrad on cross-entropy, classes weighted evenly.

    In the first `whole` of all epochs a text's words are averaged together, so that every word
    has its say in what is found toxic.  Then a text is as toxic as its most toxic span: the one
    that scores highest just then learns.
    """
    y = np.array(labels, np.int64)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(BUCKETS), float(np.inf if len(y) and y[0] else -np.inf) if len(y) else 0.0)
    raw = [t.encode() for t in texts]
    data, keys, a, b, word, start, length, doc = bag(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw]))
    grams, owner = word_buckets(data, a, b)
    order = np.argsort(owner, kind="stable")
    grams, owner = grams[order], owner[order]
    first = np.searchsorted(owner, np.arange(len(keys) + 1))
    n_grams = np.diff(first)
    of = np.searchsorted(doc, np.arange(len(y) + 1))
    n_spans, begin = len(start), start[of[:-1]]
    # after the spans, each text as a whole
    start, length = np.concatenate([start, begin]), np.concatenate([length, np.diff(np.append(begin, len(word)))])
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 1 / DIM, (BUCKETS, DIM))
    soft = rng.normal(0, 0.5, (DIM, 2))
    bias = np.zeros(2)
    g_emb, g_soft, g_bias = np.full(BUCKETS, 1e-8), 1e-8, 1e-8
    share = len(y) / (2 * np.bincount(y, minlength=2))

    def spread(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        size = hi - lo
        return np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size - lo, size)

    def scores() -> np.ndarray:
        w = np.bincount(owner, weights=(emb @ (soft[:, 1] - soft[:, 0]))[grams], minlength=len(keys)) / n_grams
        return span_means(w[word], start[:n_spans], length[:n_spans])

    def batch(spans: np.ndarray, target: np.ndarray) -> None:
        nonlocal soft, bias, g_soft, g_bias
        size = length[spans]
        w = np.repeat(np.arange(len(spans)), size) * len(keys) + word[spread(start[spans], start[spans] + size)]
        w, times = np.unique(w, return_counts=True)
        row, w = np.divmod(w, len(keys)) if len(keys) else (w, w)
        g = grams[spread(first[w], first[w + 1])]
        weight = np.repeat(times / (size[row] * n_grams[w]), n_grams[w])
        grow = np.repeat(row, n_grams[w])
        used, local = np.unique(g, return_inverse=True)
        flat = np.bincount(grow * len(used) + local, weights=weight, minlength=len(spans) * len(used)).reshape(len(spans), len(used))
        x = flat @ emb[used]
        z = x @ soft + bias
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(target)), target] -= 1
        p *= share[target][:, None] / len(target)
        d_emb = flat.T @ (p @ soft.T)
        d_soft, d_bias = x.T @ p, p.sum(0)
        g_emb[used] += (d_emb**2).mean(1)
        g_soft += (d_soft**2).mean()
        g_bias += (d_bias**2).mean()
        emb[used] -= rate * d_emb / np.sqrt(g_emb[used])[:, None]
        soft -= rate * d_soft / np.sqrt(g_soft)
        bias -= rate * d_bias / np.sqrt(g_bias)

    for epoch in range(epochs):
        if epoch < whole:
            chosen = n_spans + np.arange(len(y))
        else:
            s = scores()
            chosen = np.array([of[i] + int(np.argmax(s[of[i] : of[i + 1]])) for i in range(len(y))])
        for rows in np.array_split(rng.permutation(len(y)), max(1, len(y) // 32)):
            batch(chosen[rows], y[rows])
    return Model(emb @ (soft[:, 1] - soft[:, 0]), float(bias[1] - bias[0]))


class Scorer:
    """Scores chunks of texts; lives in a worker, with a bounded cache of words."""

    CACHE = 1_000_000

    def __init__(self, model: Model):
        self.model, self.cache = model, {}

    def score(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        n = len(offs) - 1
        data, keys, a, b, word, start, length, doc = bag(data, offs)
        value = np.array(list(map(self.cache.get, keys.tolist())), np.float64)  # None becomes nan
        new = np.flatnonzero(np.isnan(value))
        if len(new):
            grams, owner = word_buckets(data, a[new], b[new])
            value[new] = np.bincount(owner, weights=self.model.weight[grams], minlength=len(new)) / np.bincount(owner, minlength=len(new))
            if len(self.cache) + len(new) > self.CACHE:
                self.cache.clear()
            self.cache.update(zip(keys[new].tolist(), value[new].tolist(), strict=True))
        top = np.full(n, -np.inf)
        np.maximum.at(top, doc, span_means(value[word], start, length))
        return 1 / (1 + np.exp(-np.clip(top + self.model.bias, -500, 500)))


def held_out(doc_id: str = "doc_id"):
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(3)) == 1


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, **options) -> Model:
    """A model from at most `sample` rows of each class that are not held out.

    Labels that are null or held out are never read; of the others those with the smallest
    hashes of doc_id are taken, joined with their texts.  A doc_id with several labels is toxic if
    one of them says so, and one with several texts is trained on the first of them by code point.
    """
    known = labels.where("toxic in (0, 1) and doc_id is not null").where(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    parts = [known.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for c in (0, 1)]
    chosen = F.broadcast(parts[0].unionByName(parts[1]))
    some = docs.where(F.coalesce(F.octet_length("text"), F.lit(0)) <= SAMPLE_BYTES).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = sorted(some.join(chosen, "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("doc_id", "text", "toxic").collect())
    return train([t for _, t, _ in rows], [c for *_, c in rows], **options)


def score(docs: DataFrame, model: Model, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The carried columns and `score` of every row, from its whole text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = docs.select(*[docs[c] for c in carry], docs["text"].alias("__text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema.fields[:-1]] + ["score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            for lo, hi, data, offs in ta.chunks(batch.column(len(carry))):
                yield pa.RecordBatch.from_arrays([*[batch.column(i).slice(lo, hi - lo) for i in range(len(carry))], pa.array(scorer.score(data, offs))], names=[*carry, "score"])

    return out.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row of docs(doc_id, text).

    Null and empty texts are scored as a text without words, by the bias.  Without labelled rows
    every score is 0.5.  A null doc_id is not held out.  Only texts enter a score.
    """
    out = score(docs, fit(docs, labels))
    return out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
