"""Visits over a stream of observations, in session windows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.graphs import shared_folder


def visit_stream(events: DataFrame, gap: float, delay: str = "1 day") -> DataFrame:
    """Visits of a stream events(user_id, ts, value): a row per track and session, when it is closed.

    Observations later than `delay` behind the newest are late and dropped by the watermark.
    """
    # a window ends when `gap` has passed; the reference's gap must be exceeded, hence a microsecond more
    micros = int(gap * 1e6) + 1
    rows = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", delay)
    out = rows.groupBy("user_id", F.session_window("at", f"{micros} microseconds")).agg(F.min("at").alias("a"), F.max("at").alias("b"), F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("user_id").alias("track"), F.round(F.unix_micros("a") / 1e6, 6).alias("first_t"), F.round(F.unix_micros("b") / 1e6, 6).alias("last_t"), "n", F.round("total", 6).alias("total"))


def write_visits(events: DataFrame, gap: float, path: str, checkpoint: str, delay: str = "1 day", **trigger: object) -> StreamingQuery:
    """Starts a query that appends each visit to the Parquet table at path once the watermark has closed it.

    Closed visits leave the state, and observations that come after their visit was closed are dropped.
    A restart with the same checkpoint goes on where the last run stopped.
    """
    out = visit_stream(events, gap, delay).writeStream.outputMode("append").format("parquet")
    return out.option("path", path).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def visit_counts(spark: SparkSession, path: str, gap: float) -> DataFrame:
    """The visits of all files at path, read as a stream that ends; the result is a table of the shared folder.

    As the stream ends, visits that no watermark has closed count too: every trigger writes all visits
    so far, and nothing is late.  For a stream that goes on take `write_visits`.
    """
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        base = f"{shared_folder(spark)}/visits-{uuid.uuid4().hex}"
        schema = spark.read.parquet(path).schema
        folder, _, name = path.rpartition("/")
        events = spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder) if not _is_dir(spark, path) else spark.readStream.schema(schema).parquet(path)
        closing = visit_stream(events, gap)
        # every trigger writes the whole result, so the last one's files hold it when the stream ends
        write = lambda rows, _: rows.write.mode("overwrite").parquet(f"{base}/rows")
        query = closing.writeStream.outputMode("complete").foreachBatch(write).trigger(availableNow=True).option("checkpointLocation", f"{base}/state").start()
        query.awaitTermination()
        return spark.read.schema(closing.schema).parquet(f"{base}/rows")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def _is_dir(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(jpath).isDirectory()
