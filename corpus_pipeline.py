"""From raw documents to token ids: five stages, each one operator of plumbline.llm.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.jaccard_join import BROADCAST_IDS, jaccard_join
from plumbline.llm.mixing import mix_sources, word_sizes
from plumbline.llm.quality_rules import quality_rules
from plumbline.llm.sentencepieces import sp_encode
from plumbline.llm.storage import released, stored
from plumbline.llm.substring_dedup import substring_dedup

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the current policy rejects; nothing is shuffled.

    Null and empty texts have no words and go; rows that repeat are judged alike.
    """
    return quality_rules(docs, carry=COLUMNS).where("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group with five-word Jaccard similarity of 0.8 or more.

    Rows with a null doc_id are in no group and stay, as do null and empty texts; rows that repeat a
    doc_id are one document, and stay or go together.
    """
    groups = jaccard_join(docs, k=5, num=80, den=100)
    gone = stored(groups.where("doc_id <> component_id").select("doc_id").distinct(), "gone")
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes words of 13-word windows that a smaller doc_id holds; a document left without words goes.

    Null and empty texts and rows with a null doc_id stay as they are; of rows that repeat a doc_id
    none removes words of the others.
    """
    out = substring_dedup(docs.select(*COLUMNS), keep_text=True)
    return out.where("n_removed = 0 or n_removed < n_words").withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops documents so that sources come near their target words.

    A document taken twice is two rows.  Null texts and texts without words are never taken, a null
    source is a source.  Rows that repeat a doc_id and source are numbered by their size and text,
    and each takes the copies of its number, so the sources' words come out as mixed.
    """
    taken = stored(mix_sources(docs).select("doc_id", "source", "size", "number", "copies"), "copies")
    again = stored(taken.groupBy("doc_id", "source").count().where("count > 1").drop("count"), "again")
    some = taken.where("copies > 0")
    if again.isEmpty():
        some = some.select("doc_id", "source", "copies")
        rows = _matched(docs, F.broadcast(some) if some.count() <= BROADCAST_IDS else some, "doc_id", "source")
    else:
        again = F.broadcast(again) if again.count() <= BROADCAST_IDS else again
        same = F.col("d.doc_id").eqNullSafe(F.col("a.doc_id")) & F.col("d.source").eqNullSafe(F.col("a.source"))
        part = lambda x, how: x.alias("d").join(again.alias("a"), same, how)
        order = Window.partitionBy("doc_id", "source", "size").orderBy(F.xxhash64("text"), "text")
        sized = word_sizes(part(docs, "left_semi"), COLUMNS).withColumn("number", F.row_number().over(order))
        rows = _matched(part(docs, "left_anti"), part(some, "left_anti"), "doc_id", "source").unionByName(_matched(sized, some, "doc_id", "source", "size", "number"))
    return rows.select(*COLUMNS, F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).drop("copy")


def _matched(docs: DataFrame, taken: DataFrame, *keys: str) -> DataFrame:
    """The documents with their copies; nulls equal each other."""
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"d.{k}").eqNullSafe(F.col(f"t.{k}"))
    return docs.alias("d").join(taken.alias("t"), same).select(*[f"d.{c}" for c in COLUMNS], F.col("t.copies").cast("int").alias("copies"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The SentencePiece ids of every row; a null text has null ids and no tokens."""
    import public_tokenizers

    ids = sp_encode(docs, public_tokenizers.path("piece_bpe_32k.model"), carry=("doc_id", "lang", "source", "n_chars"))
    return ids.withColumn("n_tokens", F.coalesce(F.size("ids"), F.lit(0)).cast("long"))


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("mixing sources", mixing),
    ("SentencePiece encoding", token_ids),
]

#: Viterbi and pivotal rounding have no SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.split()[0].lower())
        released(spark)
    return STAGES[-1][1](spark, docs, sf_dir)
