"""The subpackage's queries: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .embedding_dedup import embedding_dedup
from .importance import importance_resample
from .jaccard_join import jaccard_join
from .mixing import mix_sources
from .oracles import ORACLES as ORACLES
from .lexical_search import BlockMaxIndex
from .quality_rules import ablations, quality_rules, stored_ledger
from .sentencepieces import sp_decode, sp_encode
from .sharding import interleaved
from .storage import shared_dir
from .substring_dedup import substring_dedup
from .tandem_runs import planted, run_digests, tandem_runs
from .token_counts import token_counts
from .toxicity import toxicity
from .warc import warc_round_trip


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = quality_rules(_table(spark, sf_dir, "documents"))
    return led.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed")


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the current policy rejects, from a stored ledger."""
    return ablations(stored_ledger(_table(spark, sf_dir, "documents"), shared_dir(spark) + "-ledger"))


def op1_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Draws 85% of the documents to look like those labelled as good."""
    target = _table(spark, sf_dir, "labels").where("quality = 1")
    return importance_resample(_table(spark, sf_dir, "documents"), target, fraction=0.85)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(_table(spark, sf_dir, "embeddings"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_round_trip(_table(spark, sf_dir, "pages"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_sentencepieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes every text, decodes the ids again and says whether the text came back."""
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("was", F.xxhash64(F.translate("text", "\u2581", " ")))
    ids = sp_encode(docs, path, carry=("doc_id", "was"))
    ids = ids.withColumn("n_tokens", F.coalesce(F.size("ids"), F.lit(0)).cast("long")).withColumn("ids_hash", F.xxhash64("ids"))
    back = sp_decode(ids, path, carry=("doc_id", "was", "n_tokens", "ids_hash"))
    same = F.xxhash64("text") == F.col("was")
    return back.select("doc_id", "n_tokens", "n_byte_pieces", "ids_hash", same.alias("round_trip"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counted = token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(_table(spark, sf_dir, "documents"), k=4, num=85, den=100)


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interleaved(_table(spark, sf_dir, "documents"), shards=40)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = BlockMaxIndex.build(_table(spark, sf_dir, "documents"))
    return index.search(_table(spark, sf_dir, "benchmark"), "item_id", k=50)


def op13_tandem_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(tandem_runs(_table(spark, sf_dir, "documents"), rewrite=planted))


QUERIES = {
    "op1_importance": op1_importance,
    "op2_mixing": op2_mixing,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_warc": op4_warc,
    "op5_toxicity": op5_toxicity,
    "op6_sentencepieces": op6_sentencepieces,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_quality_rules": op8_quality_rules,
    "op9_token_counts": op9_token_counts,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_sharding": op11_sharding,
    "op12_lexical_search": op12_lexical_search,
    "op13_tandem_runs": op13_tandem_runs,
    "quality_ablations": quality_ablations,
}
