"""A ledger of stages over content: what a stage made is known by what went into it, so a killed run goes on where it stopped."""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Buckets of leaves below the root of a tree hash, named by the first byte of a name's hash.
FAN = 256


def tree_hash(leaves: DataFrame, by: list[str], name: str, digest: str) -> DataFrame:
    """(by, n, root): one hash of each group's named digests, whatever their order and partitions.

    A leaf is the SHA-256 of `name:digest`; the leaves of a bucket, sorted, are hashed into one, and the buckets into the
    root, so no more than a 256th of a group's leaves and 256 buckets are ever put in a row.  A null counts as empty.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    x = leaves.select(*by, F.sha2(text(name), 256).alias("place"), F.sha2(F.concat(text(name), F.lit(":"), text(digest)), 256).alias("leaf"))
    joined = lambda c: F.sha2(F.concat_ws("\n", F.array_sort(F.collect_list(c))), 256)
    b = x.groupBy(*by, F.substring("place", 1, 2).alias("bucket")).agg(F.count("*").alias("n"), joined("leaf").alias("h"))
    return b.groupBy(*by).agg(F.sum("n").alias("n"), joined(F.concat("bucket", F.lit(":"), "h")).alias("root"))


def folder_hash(spark: SparkSession, path: str) -> str:
    """The tree hash of all files under a folder, by their paths below it and their bytes; each file is read by one task."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    base = files.select(F.regexp_replace(F.col("path"), r"^.*?" + "/".join(path.rstrip("/").rsplit("/", 2)[-2:]) + "/", "").alias("name"), F.sha2("content", 256).alias("digest"))
    found = tree_hash(base, [], "name", "digest").first()
    return found.root if found and found.n else hashlib.sha256(b"").hexdigest()


class StageLedger:
    """Stages of a run under a folder of the cluster's store.

    Every event (running, completed, failed) is a small table of its own, which is there whole or not at all; a stage's
    last event counts.  A completed stage with the same inputs and parameters is not run again, in this session or a later one.
    """

    SCHEMA = "stage string, key string, status string, output string, message string, at double, seq long"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _write(self, stage: str, key: str, status: str, output: str | None = None, message: str | None = None) -> None:
        row = (stage, key, status, output, message, time.time(), time.time_ns())
        self.spark.createDataFrame([row], self.SCHEMA).coalesce(1).write.parquet(f"{self.path}/events/{uuid.uuid4().hex}")

    def events(self) -> DataFrame:
        """All events whose writing ended."""
        fs = self.spark._jvm.org.apache.hadoop.fs
        root = fs.Path(f"{self.path}/events")
        system = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        done = [f.getPath().toString() for f in system.listStatus(root) if system.exists(fs.Path(f.getPath(), "_SUCCESS"))] if system.exists(root) else []
        return self.spark.read.schema(self.SCHEMA).parquet(*done) if done else self.spark.createDataFrame([], self.SCHEMA)

    def latest(self) -> DataFrame:
        """(stage, key, status, output, message, at) of each stage's last event."""
        last = F.row_number().over(Window.partitionBy("stage").orderBy(F.desc("seq")))  # a stage has a few events
        return self.events().withColumn("k", last).where("k = 1").drop("k", "seq")

    def stage(self, name: str, inputs: list[str], build: Callable[[], DataFrame], **parameters: object) -> DataFrame:
        """The stage's table: a stored one if a completed event has the same key, else what build makes.

        inputs are hashes or keys of what goes in, such as `folder_hash` and earlier stages' keys; the key is a hash of these, the
        name and the parameters.  A failing build leaves an event and is raised.
        """
        key = self.key(name, inputs, **parameters)
        done = self.events().where((F.col("stage") == name) & (F.col("key") == key) & (F.col("status") == "completed")).orderBy(F.desc("seq")).first()
        if done:
            return self.spark.read.parquet(done.output)
        output = f"{self.path}/tables/{name}-{uuid.uuid4().hex}"
        self._write(name, key, "running")
        try:
            build().write.parquet(output)
        except Exception as e:
            self._write(name, key, "failed", message=str(e)[:500])
            raise
        self._write(name, key, "completed", output)
        return self.spark.read.parquet(output)

    @staticmethod
    def key(name: str, inputs: list[str], **parameters: object) -> str:
        return hashlib.sha256("\n".join([name, *inputs, *(f"{k}={v!r}" for k, v in sorted(parameters.items()))]).encode()).hexdigest()
