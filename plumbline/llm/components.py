"""Connected components of a graph given as edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import dropped, stored

#: A node with more edges than this, and than a 50,000th of all, is hot: at most 50,000 nodes are.
HOT, SHARE = 1000, 50_000


def _joined(edges: DataFrame, low: DataFrame, n: int) -> DataFrame:
    """edges(u, v) with the m of low(u, m, d), d being u's number of edges; n is the number of all.

    A hot node's m is broadcast to its edges, of which no task then gets all; their number is
    bounded by HOT and SHARE.  Other nodes are joined by a shuffle.
    """
    hot = low.where(F.col("d") > max(HOT, n // SHARE)).select("u", F.col("m").alias("h"))
    marked = edges.join(F.broadcast(hot), "u", "left")
    cold = marked.where("h is null").select("u", "v").join(low.select("u", "m"), "u")
    return cold.unionByName(marked.where("h is not null").select("u", "v", F.col("h").alias("m")))


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component) for every id in edges(a, b); component is the smallest id reachable.

    Each round relinks neighbours to the smallest id they see, first those above a node,
    then those below it, and so needs a logarithmic number of rounds; all state is in
    tables and the driver sees counts only.  Loops, repeated and null-ended edges are harmless.
    A node's smallest neighbour comes from a partial aggregation; a hot node's is broadcast.
    """
    e = edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = stored(e, "edges")
    sign = lambda x: x.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    was = sign(e)
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("d")).select("u", F.least("u", "m").alias("m"), "d")
        large = _joined(both.where("v > u"), low, 2 * was[0]).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, "edges")
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("d"))
        small = _joined(large, low, was[0]).select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        new = stored(small, "edges")
        now = sign(new)
        dropped(e, large)
        e = new
        if was == now:
            break
        was = now
    else:
        raise RuntimeError(f"the components did not settle in {rounds} rounds")
    # settled: every u has one v, its root, and no root is a u
    roots = e.select(F.col("v").alias("id")).distinct().withColumn("component", F.col("id"))
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
