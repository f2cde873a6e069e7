"""Ranked lexical search with block-max pruning.

The index holds document ranges as blocks: consecutive documents of about 128 kB of text.  A block has
a forward index (the terms of each document with their counts) and, for each of its terms, the
largest impact that the term has in a document of the block.  The sum of a query's weighted
maxima bounds the score of every document of a block.  A search

1. sums document frequencies of the queries' terms over the blocks' term lists,
2. finds the few blocks of highest bound for each query and scores them: the k-th best score found is
   a threshold that a document must reach,
3. sorts the blocks that a task has by their bounds and scores them for a query, until a bound is
   below the query's threshold, which rises as better documents are found.

Only the k best of each task and query are shuffled.  Terms are 64-bit hashes.  Scores are
integers, so ties are exact and ranks agree between runs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textarrays as ta
from .storage import shared_dir

U64 = np.uint64
#: Bytes of text of a block, blocks that give a query's first threshold, and query terms handled at a time.
BLOCK, SEEDS, GROUP = 128 << 10, 4, 500_000
#: Documents times terms up to which a block that is searched holds them as a table.
TABLE = 1 << 17
#: Stands for a null doc_id, which sorts last.
NULL = np.iinfo(np.int64).max
#: Spark reads up to 4,096 rows of a row group at once, and a row is a block of some 200 kB: groups are kept small, and looked at every few rows.
_GROUPS = {"parquet.block.size": str(8 << 20), "parquet.page.size.row.check.min": "4"}

_INDEX = "block bigint, ids binary, lengths binary, terms binary, df binary, maxima binary, sizes binary, post_terms binary, post_counts binary"


def _terms(batch: pa.RecordBatch, column: int, limit: int) -> Iterator[tuple]:
    """(first row, row after the last, hashes, row of each) of the batch's terms, block by block."""
    for lo, hi, data, offs in ta.chunks(batch.column(column), limit):
        lower = ta.LOWER[data]
        starts, ends, doc = ta.terms(lower, offs)
        yield lo, hi, ta.span_hash(lower, starts, ends), doc


def impact(count: np.ndarray, length: np.ndarray, n: int, total: int) -> np.ndarray:
    """What an occurrence count adds to a score, for a weight of 1; length is the document's number of terms."""
    m = 100 - 50 + (50 * length * n) // total
    return (1_000_000_000 * count) // (1000 * count + 20 * m)


def _counted(docs: DataFrame) -> tuple[int, int]:
    """The documents with a term, and all terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = total = 0
        for batch in batches:
            for _, _, data, offs in ta.chunks(batch.column(0)):
                _, _, doc = ta.terms(data, offs)
                some, total = some + len(np.unique(doc)), total + len(doc)
        yield pa.RecordBatch.from_arrays([pa.array([some]), pa.array([total])], names=["some", "total"])

    row = docs.select("text").mapInArrow(run, "some bigint, total bigint").agg(F.sum("some"), F.sum("total")).first()
    return row[0] or 0, row[1] or 0


class Queries:
    """The terms of some queries: a sorted table of all, with each query's places in it, and their weights."""

    def __init__(self, terms: list[np.ndarray]):
        self.flat = np.concatenate(terms) if terms else np.zeros(0, U64)
        self.terms, self.places = np.unique(self.flat, return_inverse=True)
        size = np.array([len(t) for t in terms], np.int64)
        self.ends = np.cumsum(size)
        self.starts = self.ends - size
        self.weights = np.zeros(len(self.terms), np.int64)

    def weigh(self, df: np.ndarray, n: int) -> None:
        self.weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)

    def found(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in terms, place in the queries' table) of the terms that queries have."""
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        here = np.flatnonzero(self.terms[at] == terms)
        return here, at[here]

    def bounds(self, terms: np.ndarray, maxima: np.ndarray) -> np.ndarray:
        """For each query, what no document of a block can exceed."""
        here, at = self.found(terms)
        value = np.zeros(len(self.terms), np.int64)
        value[at] = self.weights[at] * maxima[here]
        total = np.append(0, np.cumsum(value[self.places]))
        return total[self.ends] - total[self.starts]


def _ints(batch: pa.RecordBatch, name: str, row: int, kind: type = np.int32) -> np.ndarray:
    return np.frombuffer(batch.column(name)[row].as_buffer(), kind)


class BlockMaxIndex:
    """An index under a folder, and its numbers: n documents with a term, total terms of all."""

    def __init__(self, spark: SparkSession, path: str, n: int, total: int):
        self.spark, self.path, self.n, self.total = spark, path, n, total

    @classmethod
    def build(cls, docs: DataFrame, path: str | None = None) -> BlockMaxIndex:
        """Indexes the whole texts of docs(doc_id, text).

        Null and empty texts, and those without a term, count nowhere.  A row is a document: rows that share a
        doc_id are ranked each on its own, and a null doc_id comes after all others.  Other columns are ignored.
        """
        spark, path = docs.sparkSession, path or shared_dir(docs.sparkSession) + "-blockmax"
        rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
        n, total = _counted(rows)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number = TaskContext.get().partitionId() << 32
            for batch in batches:
                ids = batch.column(0).fill_null(NULL).to_numpy()
                for lo, hi, hashes, doc in _terms(batch, 1, BLOCK):
                    if not len(hashes):
                        continue
                    words, place = np.unique(hashes, return_inverse=True)
                    key, count = np.unique(doc * len(words) + place, return_counts=True)
                    of, term = key // len(words), key % len(words)
                    length = np.bincount(doc, minlength=hi - lo)
                    maxima = np.zeros(len(words), np.int64)
                    np.maximum.at(maxima, term, impact(count, length[of], n, total))
                    cut = lambda x: x.astype(np.int32).tobytes()
                    cols = [ids[lo:hi].tobytes(), length.tobytes(), words.tobytes(), cut(np.bincount(term)), cut(maxima), cut(np.bincount(of, minlength=hi - lo)), cut(term), cut(count)]
                    yield pa.RecordBatch.from_arrays([pa.array([number]), *[pa.array([c], pa.binary()) for c in cols]], names=["block", "ids", "lengths", "terms", "df", "maxima", "sizes", "post_terms", "post_counts"])
                    number += 1

        rows.mapInArrow(run, _INDEX).write.options(compression="zstd", **_GROUPS).parquet(path)
        return cls(spark, path, n, total)

    def _read(self, *columns: str) -> DataFrame:
        return self.spark.read.schema(_INDEX).parquet(self.path).select(*columns)

    def _frequencies(self, queries: Queries) -> np.ndarray:
        held = self.spark.sparkContext.broadcast(queries)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            q = held.value
            df = np.zeros(len(q.terms), np.int64)
            for batch in batches:
                for i in range(batch.num_rows):
                    here, at = q.found(_ints(batch, "terms", i, U64))
                    df[at] += _ints(batch, "df", i)[here]
            some = np.flatnonzero(df)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], names=["place", "df"])

        out = np.zeros(len(queries.terms), np.int64)
        for r in self._read("terms", "df").mapInArrow(run, "place bigint, df bigint").groupBy("place").agg(F.sum("df").alias("df")).collect():  # a row for each query term
            out[r.place] = r.df
        return out

    def _seeds(self, queries: Queries) -> list[int]:
        """The blocks of highest bound of each query."""
        held = self.spark.sparkContext.broadcast(queries)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            q = held.value
            best = np.zeros((SEEDS, len(q.ends)), np.int64)
            blocks = np.full((SEEDS, len(q.ends)), -1, np.int64)
            for batch in batches:
                for i in range(batch.num_rows):
                    bound = q.bounds(_ints(batch, "terms", i, U64), _ints(batch, "maxima", i))
                    low = best.argmin(axis=0)
                    up = np.flatnonzero(bound > best[low, np.arange(len(bound))])
                    best[low[up], up], blocks[low[up], up] = bound[up], batch.column("block")[i].as_py()
            rank, query = np.nonzero(best)
            yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(best[rank, query]), pa.array(blocks[rank, query])], names=["query", "bound", "block"])

        found = self._read("block", "terms", "maxima").mapInArrow(run, "query bigint, bound bigint, block bigint")
        top = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("bound"), "block"))
        return [r.block for r in found.withColumn("k", top).where(F.col("k") <= SEEDS).select("block").distinct().collect()]  # SEEDS for each query of a bounded group

    def _scored(self, blocks: DataFrame, queries: Queries, floor: np.ndarray, k: int) -> DataFrame:
        """(query, doc_id, score): of each task and query the k best documents that reach the floor."""
        held, n, total = self.spark.sparkContext.broadcast((queries, floor)), self.n, self.total

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            q, floor = held.value
            least, none = np.maximum(floor, 1), np.zeros(0, np.int64)  # a score of 0 is no match
            best = [(none, none)] * len(least)
            for batch in batches:
                for lo in range(0, batch.num_rows, 64):
                    part = batch.slice(lo, 64)
                    bound = np.array([q.bounds(_ints(part, "terms", i, U64), _ints(part, "maxima", i)) for i in range(part.num_rows)])
                    ready: dict[int, Block] = {}
                    for query in np.flatnonzero((bound >= least).any(axis=0)).tolist():
                        mine = q.places[q.starts[query] : q.ends[query]]
                        for i in np.argsort(-bound[:, query], kind="stable").tolist():
                            if bound[i, query] < least[query]:
                                break
                            if i not in ready:
                                ready[i] = Block(part, i, q, n, total)
                            ids, scores = ready[i].scores(mine, least[query])
                            if not len(ids):
                                continue
                            ids, scores = np.append(best[query][0], ids), np.append(best[query][1], scores)
                            top = np.lexsort((ids, -scores))[:k]
                            best[query] = ids[top], scores[top]
                            if len(top) == k:
                                least[query] = max(least[query], scores[top[-1]])
            size = [len(x) for x, _ in best]
            ids = np.concatenate([none, *[x for x, _ in best]])
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(size)), size)), pa.array(ids, mask=ids == NULL), pa.array(np.concatenate([none, *[x for _, x in best]]))], names=["query", "doc_id", "score"])

        return blocks.mapInArrow(run, "query bigint, doc_id bigint, score bigint")

    def search(self, queries: DataFrame, key: str = "item_id", k: int = 50) -> DataFrame:
        """(key, rank, doc_id, score): the k best documents of each query(key, text) with a score above 0.

        Rows of queries that share a key are one query with the terms of all; a query without a term, by
        a null or empty text or for lack of letters, has no rows; a null key is a key.  Equal scores rank by doc_id.
        Queries are handled in groups of about 500,000 terms.
        """

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lo, hi, hashes, doc in _terms(batch, 1, 384 << 10):
                    cuts = np.append(0, np.cumsum(np.bincount(doc, minlength=hi - lo))).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(cuts), pa.array(hashes.view(np.int64)))], names=["key", "terms"])

        kind = queries.schema[key].dataType.simpleString()
        asked = queries.select(queries[key].alias("key"), queries["text"].alias("text")).mapInArrow(run, f"key {kind}, terms array<bigint>")
        asked = asked.withColumn("terms", F.array_distinct("terms")).where(F.size("terms") > 0)
        groups = 1 + (asked.agg(F.sum(F.size("terms"))).first()[0] or 0) // GROUP
        out = None
        for g in range(groups):
            some = asked if groups == 1 else asked.where(F.pmod(F.xxhash64("key"), F.lit(groups)) == g)
            found = self._group(some, kind, k)
            out = found if out is None else out.unionByName(found)
        return out.select(F.col("key").alias(key), "rank", "doc_id", "score")

    def _group(self, asked: DataFrame, kind: str, k: int) -> DataFrame:
        terms: dict = {}
        for r in asked.collect():  # one bounded group of queries
            terms.setdefault(r.key, []).append(np.array(r.terms, np.int64).view(U64))
        names = self.spark.createDataFrame(list(enumerate(terms)), f"query bigint, key {kind}")
        q = Queries([np.unique(np.concatenate(x)) for x in terms.values()])
        if not terms or not self.total:
            return names.where("false").select("key", F.lit(1).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
        q.weigh(self._frequencies(q), self.n)
        best = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
        seeds = self._read("*").where(F.col("block").isin(self._seeds(q)))
        floor = np.zeros(len(terms), np.int64)
        for r in self._scored(seeds, q, floor, k).withColumn("rank", best).where(F.col("rank") == k).collect():  # one row for each query
            floor[r.query] = r.score
        found = self._scored(self._read("*"), q, floor, k).withColumn("rank", best).where(F.col("rank") <= k)
        return found.join(F.broadcast(names), "query").select("key", "rank", "doc_id", "score")


class Block:
    """One block's documents and what the queries' terms add to their scores, term by term."""

    def __init__(self, batch: pa.RecordBatch, row: int, q: Queries, n: int, total: int):
        self.ids = _ints(batch, "ids", row, np.int64)
        here, at = q.found(_ints(batch, "terms", row, U64))
        self.places = np.append(at, len(q.terms))  # in order; the last is no term's
        column = np.full(len(batch.column("terms")[row].as_buffer()) // 8, -1, np.int64)
        column[here] = np.arange(len(here))
        column = column[_ints(batch, "post_terms", row)]
        mine = np.flatnonzero(column >= 0)
        mine = mine[np.argsort(column[mine], kind="stable")]
        self.doc = np.repeat(np.arange(len(self.ids)), _ints(batch, "sizes", row))[mine]
        count = _ints(batch, "post_counts", row)[mine].astype(np.int64)
        self.added = q.weights[at[column[mine]]] * impact(count, _ints(batch, "lengths", row, np.int64)[self.doc], n, total)
        self.cuts = np.append(0, np.cumsum(np.bincount(column[mine], minlength=len(here))))
        self.table = np.zeros((len(here), len(self.ids)) if len(here) * len(self.ids) <= TABLE else (0, 0), np.int64)  # faster where it is small
        if self.table.size:
            self.table[column[mine], self.doc] = self.added

    def scores(self, terms: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """The documents with a score of at least `least`, and their scores."""
        rows = np.searchsorted(self.places, terms)
        rows = rows[self.places[rows] == terms]
        if self.table.size:
            scores = self.table[rows].sum(axis=0)
        else:
            size = self.cuts[rows + 1] - self.cuts[rows]
            at = np.repeat(self.cuts[rows + 1] - np.cumsum(size), size) + np.arange(size.sum())
            scores = np.zeros(len(self.ids), np.int64)
            np.add.at(scores, self.doc[at], self.added[at])
        ok = np.flatnonzero(scores >= least)
        return self.ids[ok], scores[ok]
