"""Connected components by hooking to the smallest label and jumping along labels."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: A label that more nodes than this carry is broadcast rather than shuffled to.
HOT = 1000


def checkpointed(df: DataFrame) -> DataFrame:
    """df with its lineage cut, in the session's checkpoint folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder.

    Without spark.checkpoint.dir a temporary folder takes its place, but only where driver and
    executors are one process; on a cluster that is an error.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base and (not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(base or tempfile.mkdtemp(prefix="checkpoint-"))
    return sc.getCheckpointDir()


def written(df: DataFrame, old: DataFrame | None = None) -> DataFrame:
    """df as a table in the shared folder, for loops: unlike a checkpoint it keeps nothing of the plan, whose constraints multiply in self-joins.

    `old`, an earlier result of this function, is deleted once the new table is there.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    if old is not None:
        place = spark._jvm.org.apache.hadoop.fs.Path(old.written_to)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def _with_root(hooked: DataFrame, labels: DataFrame) -> DataFrame:
    """hooked(id, old, label) with the label's own label as root.

    Labels that many nodes carry are few, so their rows are broadcast; the rest is shuffled, and no
    task gets all members of a large component.
    """
    up = labels.select(F.col("id").alias("label"), F.col("label").alias("root"))
    hot = hooked.groupBy("label").count().where(F.col("count") > HOT).select("label")
    hot = checkpointed(up.join(hot, "label", "left_semi"))
    n = hot.count()
    if not n or n > 100_000:
        return hooked.join(up, "label", "left")
    x = hooked.join(F.broadcast(hot), "label", "left")
    cold = x.where("root is null").drop("root").join(up, "label", "left")
    return x.where("root is not null").unionByName(cold.select(*x.columns))


def components(nodes: DataFrame, edges: DataFrame, rounds: int = 100) -> DataFrame:
    """(id, label) of nodes(id) under edges(a, b); label is the smallest id reachable.

    A round takes the smallest label around each node and then that label's own label, which
    halves a path's length; it ends when no label changes.
    """
    both = checkpointed(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = checkpointed(nodes.select("id", F.col("id").alias("label")).distinct())
    for _ in range(rounds):
        around = both.join(labels, both.b == labels.id).groupBy(F.col("a").alias("id")).agg(F.min("label").alias("low"))
        hooked = labels.join(around, "id", "left").select("id", F.col("label").alias("old"), F.least("label", "low").alias("label"))
        hooked = checkpointed(hooked)
        new = checkpointed(_with_root(hooked, labels).select("id", "old", F.least("label", "root").alias("label")))
        labels = new.select("id", "label")
        if new.where("label <> old").isEmpty():
            return labels
    raise RuntimeError(f"the labels did not settle in {rounds} rounds")
