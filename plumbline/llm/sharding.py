"""Shards that each hold the mixture of sources: proportional stratified interleaving.

The rows of a source are shuffled by a seeded hash and ranked; rank r of n gets the fraction
(r + u) / n, with an offset u in [0, 1) of the source's own.  Sorted by fraction, sources are spread evenly
over the whole sequence, and cut into equal pieces every piece has each source's share, to within
a row.  Both rankings are made in cells (of the hash within a source, of the fraction over all) that hold a
few thousand rows whatever a source's size: a row's rank is its rank in its cell and the rows of
the cells before, which a table of counts gives.  All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import shared_dir, stored

#: Rows in a cell, about, and the most cells: beyond 65,536 cells they grow instead.
CELL, CELLS = 4096, 65_536
SPAN = 1 << 60


def seeded(seed: int, *values: Column) -> Column:
    """A hash in [0, 2^60) of the values' text, which any engine with MD5 can compute."""
    text = F.concat_ws("/", F.lit(str(seed)), *[v.cast("string") for v in values])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def _before(counts: DataFrame, by: list[str]) -> DataFrame:
    """counts(by, cell, n) with `before`, the rows of the cells before, and `all`, those of all cells."""
    line = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    so_far = F.sum("n").over(line.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))
    return counts.select(*by, "cell", F.coalesce(so_far, F.lit(0)).alias("before"), F.sum("n").over(line).alias("all"))


def interleaved(docs: DataFrame, shards: int = 40, seed: int = 11, keep_rows: bool = False) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row of docs, and the row itself as a struct if keep_rows.

    The law is `rows`: shards' numbers of rows differ by one at most.  size is the text's UTF-8 bytes and
    16, text_crc32 its unsigned CRC-32; a null text counts as empty in both, a long one is like any other.
    A null source is a source of its own, a null doc_id is hashed as no text.  Rows that share a
    doc_id are ordered by checksum and size; rows equal in all of that are interchangeable, so
    reruns agree.  Equal texts are not held together, as the mixture decides; grown_shard is null.
    More shards than rows leave some empty, an empty table gives no rows, other columns are ignored.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    source = F.coalesce(F.concat(F.lit("s"), docs["source"].cast("string")), F.lit("n"))
    row = [F.struct(*[docs[c] for c in docs.columns]).alias("row")] if keep_rows else []
    rows = docs.select(docs["doc_id"].alias("doc_id"), (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), source.alias("source"), seeded(seed, docs["doc_id"]).alias("h"), *row)
    total = docs.count()
    cells = max(1, min(CELLS, total // CELL))
    rows = rows.withColumn("cell", F.floor(F.col("h") / (SPAN // cells)).cast("int"))
    order = ["h", "doc_id", "text_crc32", "size"]
    before = _before(rows.groupBy("source", "cell").agg(F.count("*").alias("n")), ["source"])
    rank = F.row_number().over(Window.partitionBy("source", "cell").orderBy(*order)) - 1
    offset = seeded(seed + 1, F.col("source")) / F.lit(float(SPAN))
    ranked = rows.withColumn("rank", rank).join(before, ["source", "cell"]).withColumn("fraction", (F.col("rank") + F.col("before") + offset) / F.col("all"))
    ranked = stored(ranked.select(*order, "source", "fraction", F.floor(F.col("fraction") * cells).cast("int").alias("cell"), *["row"] * keep_rows), "ranked")
    # at most CELLS rows, whatever the input: they fit one task and a broadcast
    before = _before(ranked.groupBy("cell").agg(F.count("*").alias("n")), [])
    place = F.row_number().over(Window.partitionBy("cell").orderBy("fraction", "source", *order)) - 1
    out = ranked.withColumn("place", place).join(F.broadcast(before), "cell").withColumn("place", F.col("place") + F.col("before"))
    n = max(total, 1)
    out = out.withColumn("shard", F.expr(f"cast((place * {shards}L) div {n}L as int)"))
    slot = F.expr(f"place - (shard * {n}L + {shards - 1}L) div {shards}L")  # less the shard's first place
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", slot.alias("slot"), F.lit(None).cast("int").alias("grown_shard"), *["row"] * keep_rows)


def write_shards(docs: DataFrame, path: str | None = None, shards: int = 40, seed: int = 11) -> str:
    """Writes the rows of docs as Parquet under path/shard=N, with their slots; returns the path.

    A shard is several files, each with a stretch of its slots in order.  Columns of docs named
    shard or slot are replaced.
    """
    path = path or shared_dir(docs.sparkSession) + "-shards"
    placed = interleaved(docs.drop("shard", "slot"), shards, seed, keep_rows=True)
    placed.select("row.*", "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return path
