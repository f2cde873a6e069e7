"""Which sidecar frame each decoded video frame belongs to, for a stream of frames and for a table.

A capture's frames come in the order of their decoding.  Both clocks count from their first time; a frame takes
the nearest sidecar time that lies after all taken so far and within the tolerance, else it is unmatched, so no
neighbour is ever shifted.  As soon as a frame's time is missing or does not grow the capture goes over to
index mode for good: frame n is sidecar frame n.  What a capture must remember is one row, so a stream keeps it
as state and a table folds it in one pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

_STATE = "origin double, last double, usable boolean, used int, at long"
_NAMES = ("video_index", "sidecar_index", "pts_s", "sidecar_s", "delta_s", "method")
_ROW = "video_index long, sidecar_index long, pts_s double, sidecar_s double, delta_s double, method string"


class Clock:
    """A capture's cursor: the first time, the last one, whether times can be used, the last sidecar frame taken, the last frame seen."""

    def __init__(self, times: np.ndarray | None, expected: int, tolerance: float | None, by_time: bool, state: tuple | None = None):
        fine = times is not None and len(times) == expected and np.isfinite(times).all() and not (np.diff(times) < 0).any()
        self.times = times - times[0] if fine and len(times) else np.zeros(0) if fine else None
        self.expected, self.by_time, self.tolerance = expected, by_time, tolerance
        if fine and tolerance is None:
            steps = np.diff(times)
            self.tolerance = max(float(np.median(steps[steps > 0]) * 0.75), 0.05) if (steps > 0).any() else None
        self.origin, self.last, self.usable, self.used, self.at = state or (None, None, None if fine else False, -1, -1)

    def state(self) -> tuple:
        return self.origin, self.last, self.usable, self.used, self.at

    def take(self, index: int, pts_ms: float | None) -> tuple | None:
        """The row of a frame; null for one seen before."""
        if index <= self.at:
            return None
        self.at = index
        known = pts_ms is not None and np.isfinite(pts_ms)
        pts = pts_ms / 1000.0 if known else None
        if self.by_time and self.usable is not False:
            self.usable = known and not (self.last is not None and pts <= self.last)
            self.last = pts if known else self.last
        chosen = there = delta = None
        method = "index"
        if self.by_time and self.usable is not False and known and len(self.times):
            self.origin = pts if self.origin is None else self.origin
            now = pts - self.origin
            k = int(np.searchsorted(self.times, now))
            k = min((x for x in (k, k - 1) if 0 <= x < len(self.times)), key=lambda x: abs(self.times[x] - now))
            delta, method = abs(float(self.times[k] - now)), "pts_unmatched"
            if (self.tolerance is None or delta <= self.tolerance) and k > self.used:
                chosen, there, self.used, method = k, float(self.times[k]), k, "pts_nearest"
        if method == "index":
            chosen = index if index < self.expected else None
            method = "index_fallback" if self.by_time else "index"
        return index, chosen, pts - self.origin if known and self.origin is not None else None, there, delta, method


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=list(_NAMES)).astype({"video_index": "int64", "sidecar_index": "Int64", "pts_s": float, "sidecar_s": float, "delta_s": float})


def _clock(g: pd.DataFrame, tolerance: float | None, by_time: bool, state: tuple | None = None) -> Clock:
    times = g["times"].iloc[0]
    return Clock(None if times is None else np.array(times, float), int(g["expected"].iloc[0]), tolerance, by_time, state)


def _walk(clock: Clock, g: pd.DataFrame) -> pd.DataFrame:
    g = g.sort_values("video_index", kind="stable")
    rows = (clock.take(int(i), None if pd.isna(p) else float(p)) for i, p in zip(g["video_index"], g["pts_ms"], strict=True))
    return _frame([r for r in rows if r is not None])


def associated(frames: DataFrame, sidecars: DataFrame, key: str, tolerance: float | None = None, by_time: bool = True) -> DataFrame:
    """(key, video_index, sidecar_index, pts_s, sidecar_s, delta_s, method) of frames(key, video_index, pts_ms).

    sidecars(key, expected, times): how many sidecar frames a capture has, and their times; where these are null, not
    as many, or do not ascend, the capture is in index mode.  frames may be a stream, whose rows of a capture must come
    in order, but may be split over triggers anywhere; a frame that comes again is left out.  Without a tolerance
    it is three quarters of the median step, 0.05 at least.
    """
    kind = dict(frames.dtypes)[key]
    x = frames.join(F.broadcast(sidecars) if not frames.isStreaming and sidecars.count() <= 10_000 else sidecars, key).select(key, "video_index", "pts_ms", "expected", "times")
    if not frames.isStreaming:

        def fold(g: pd.DataFrame) -> pd.DataFrame:
            out = _walk(_clock(g, tolerance, by_time), g)
            out.insert(0, key, g[key].iloc[0])
            return out

        return x.groupBy(key).applyInPandas(fold, f"{key} {kind}, {_ROW}")

    def step(name: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        g = pd.concat(list(parts))
        clock = _clock(g, tolerance, by_time, state.get if state.exists else None)
        out = _walk(clock, g)
        state.update(clock.state())
        out.insert(0, key, name[0])
        yield out

    return x.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, {_ROW}", _STATE, "append", GroupStateTimeout.NoTimeout)


def availability(rows: DataFrame, sidecars: DataFrame, key: str) -> DataFrame:
    """(key, expected, decoded, matched, missing, pts_status): what became of each capture's frames; rows as associated gives them."""
    per = rows.groupBy(key).agg(F.count("*").alias("decoded"), F.count("sidecar_index").alias("matched"), F.collect_set("sidecar_index").alias("have"), F.max(F.col("method") == "index_fallback").alias("fell"))
    x = sidecars.select(key, "expected").join(per, key, "left")
    every = F.when(F.col("expected") > 0, F.sequence(F.lit(0).cast("long"), F.col("expected").cast("long") - 1)).otherwise(F.array().cast("array<bigint>"))
    missing = F.array_except(every, F.coalesce("have", F.array().cast("array<bigint>")))
    status = F.when(F.col("fell").isNull(), "not_evaluated").when(F.col("fell"), "index_fallback").otherwise("used")
    return x.select(key, "expected", F.coalesce("decoded", F.lit(0)).alias("decoded"), F.coalesce("matched", F.lit(0)).alias("matched"), missing.alias("missing"), status.alias("pts_status"))
