"""Tables that cut a plan's lineage, in the folder all executors share."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """A new folder name under spark.checkpoint.dir.

    Where that is unset a temporary folder takes its place, but only if driver and executors
    are one process; on a cluster each executor would write to its own disk, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def stored(df: DataFrame, sub: str = "") -> DataFrame:
    """df, written once as Parquet and read again: later plans start from the files."""
    path = shared_dir(df.sparkSession) + (f"-{sub}" if sub else "")
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path  # read by dropped
    return out


def dropped(*tables: DataFrame | None) -> None:
    """Deletes what `stored` wrote, once later tables hold all that is needed of it."""
    for t in tables:
        if t is not None:
            spark = t.sparkSession
            place = spark._jvm.org.apache.hadoop.fs.Path(t.stored_at)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def released(spark: SparkSession) -> None:
    """Lets the driver forget plans that nothing refers to any more: Spark then deletes their shuffle files.

    Without it they stay on the executors' disks until the driver happens to collect its garbage.
    """
    gc.collect()
    spark._jvm.System.gc()
