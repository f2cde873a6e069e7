"""Spatial capture analytics on Spark: joins in time and space, evidence, scope and scoring."""
