"""The registry of queries and of their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import causes, clocks, damages, hashes, measured, outlines, peels, rooms, rules, series, shapes, space, surveys

_PLANS = (series, space, rules, shapes, outlines, peels, rooms, damages, measured, clocks, surveys, hashes, causes)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {n: q for p in _PLANS for n, q in p.QUERIES.items()}
ORACLES: dict[str, str] = {n: q for p in _PLANS for n, q in p.ORACLES.items()}
