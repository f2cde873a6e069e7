"""The five ways in which coordinates become cells, by name, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trunc_clip(x: Column, step: float, n: int) -> Column:
    """Truncated towards zero, then clipped into [0, n)."""
    return F.least(F.greatest((x / step).cast("long"), F.lit(0)), F.lit(n - 1))


def floor_drop(x: Column, step: float, n: int) -> Column:
    """Floor; null outside [0, n)."""
    cell = F.floor(x / step)
    return F.when((cell >= 0) & (cell < n), cell)


def half_even(x: Column, step: float) -> Column:
    """Rounded half to even."""
    return F.bround(x / step).cast("long")


def trunc(x: Column, step: float) -> Column:
    """Truncated towards zero, so that bin 0 is twice as wide."""
    return (x / step).cast("long")


def rint_clip(x: Column, low: Column, span: Column, n: int) -> Column:
    """(x - low) / span of n cells, rounded half to even and clipped into [0, n)."""
    return F.least(F.greatest(F.bround((x - low) / span * n).cast("long"), F.lit(0)), F.lit(n - 1))
