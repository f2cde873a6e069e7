"""Pose graphs: errors of constraints between poses, and what a graph scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import poses


def constraint_errors(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """edges(graph, source, target, measured, information, is_loop) with metres and radians of error.

    nodes(graph, node, pose).  An edge without both of its nodes is left out.
    """
    at = lambda name: nodes.select("graph", F.col("node").alias(name), F.col("pose").alias(f"{name}_pose"))
    x = edges.join(at("source"), ["graph", "source"]).join(at("target"), ["graph", "target"])
    x = x.withColumn("predicted", poses.relative(F.col("target_pose"), F.col("source_pose")))
    metres, radians = poses.constraint_error(F.col("predicted"), F.col("measured"))
    return x.select(*edges.columns, metres.alias("metres"), radians.alias("radians"))


def graph_scores(errors: DataFrame) -> DataFrame:
    """(graph, objective, loop_residual): the information-weighted mean squared error, and the mean error of loops, null without any."""
    turn = poses.ROTATION_METRES * F.col("radians")
    squared: Column = F.col("metres") * F.col("metres") + turn * turn
    loop = F.when(F.col("is_loop"), F.hypot(F.col("metres"), turn))
    objective = F.sum(F.col("information") * squared) / F.sum("information")
    return errors.groupBy("graph").agg(objective.alias("objective"), F.avg(loop).alias("loop_residual"))


def with_constant(graphs: DataFrame, scores: DataFrame) -> DataFrame:
    """Scores of all graphs(graph); one without constraints has an objective of 0."""
    return graphs.join(scores, "graph", "left").withColumn("objective", F.coalesce("objective", F.lit(0.0)))
