"""Operators whose result depends on order: a state is carried along each sorted group."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keyframes(df: DataFrame, key: str, t: str, value: str, tie: str, step: float, max_gap: int) -> DataFrame:
    """(key, t, tie): rows that moved more than `step` from the last kept one, or came max_gap rows after it."""

    def fold(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values([t, tie], kind="stable").reset_index(drop=True)
        kept, last = [], None
        for i, v in enumerate(g[value].tolist()):
            if last is None or abs(v - last[1]) > step or i - last[0] >= max_gap:
                kept.append(i)
                last = i, v
        return g.loc[kept, [key, t, tie]]

    kinds = dict(df.dtypes)
    return df.select(key, t, value, tie).groupBy(key).applyInPandas(fold, f"{key} {kinds[key]}, {t} {kinds[t]}, {tie} {kinds[tie]}")


def associate(frames: DataFrame, marks: DataFrame, key: str, t: str, id_: str, tolerance: float) -> DataFrame:
    """(key, frame_id, mark_id, delta): each frame with the nearest mark that follows all marks used so far.

    Both sides count from their first time.  Of equally near marks the later is taken; a frame
    without a mark within the tolerance, or whose mark was used, has null.
    """

    def fold(f: pd.DataFrame, m: pd.DataFrame) -> pd.DataFrame:
        f, m = (x.sort_values([t, id_], kind="stable") for x in (f, m))
        ft, mt = (x[t].to_numpy(float) - (x[t].min() if len(x) else 0.0) for x in (f, m))
        out, used = [], -1
        for i, x in zip(f[id_].tolist(), ft, strict=True):
            j = int(mt.searchsorted(x))
            near = [k for k in (j, j - 1) if 0 <= k < len(mt)]
            k = min(near, key=lambda k: abs(mt[k] - x), default=None)
            if k is None or k <= used or abs(mt[k] - x) > tolerance:
                out.append((i, None, None))
            else:
                used = k
                out.append((i, m[id_].iloc[k], mt[k] - x))
        got = pd.DataFrame(out, columns=["frame_id", "mark_id", "delta"]).astype({"mark_id": "Int64", "delta": "float64"})
        got.insert(0, key, f[key].iloc[0] if len(f) else None)
        return got

    kind = dict(frames.dtypes)[key]
    return frames.select(key, t, id_).groupBy(key).cogroup(marks.select(key, t, id_).groupBy(key)).applyInPandas(fold, f"{key} {kind}, frame_id long, mark_id long, delta double")


def fuse_intervals(df: DataFrame, key: str, low: str, high: str, confidence: str, id_: str, centre: float = 0.35, share: float = 0.15) -> DataFrame:
    """Greedy first-fit grouping against group heads, most confident first, then fusion.

    (key, head, n, low, high, confidence): bounds are means weighted by confidence of at least
    0.05, the confidence is one minus the product of the doubts.  Order matters, as a group is
    known by its first member only.
    """

    def fused(k: object, rows: list[tuple]) -> list[tuple]:
        groups: list[list] = []
        for r in rows:
            for members in groups:
                a, b = members[0], r
                union = max(a[2], b[2]) - min(a[1], b[1])
                both = max(0.0, min(a[2], b[2]) - max(a[1], b[1])) / union if union > 1e-9 else 0.0
                if abs(a[1] + a[2] - b[1] - b[2]) / 2 <= centre or both >= share:
                    members.append(r)
                    break
            else:
                groups.append([r])
        out = []
        for m in groups:
            w = [max(0.05, x[3]) for x in m]
            doubt = 1.0
            for x in m:
                doubt *= 1 - x[3]
            out.append((k, m[0][0], len(m), *(sum(a * x[i] for a, x in zip(w, m, strict=True)) / sum(w) for i in (1, 2)), 1 - doubt))
        return out

    kinds = dict(df.dtypes)
    schema = f"{key} {kinds[key]}, head {kinds[id_]}, n long, low double, high double, confidence double"

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Keys follow one another, so a task holds one key's rows and makes no frame for each."""
        types: pa.Schema | None = None
        last, rows, out = None, [], []
        for batch in batches:
            c = batch.schema
            types = pa.schema([(key, c.field(0).type), ("head", c.field(1).type), ("n", pa.int64()), *((x, pa.float64()) for x in ("low", "high", "confidence"))])
            for k, *r in zip(*(col.to_pylist() for col in batch.columns), strict=True):
                if rows and k != last:
                    out += fused(last, rows)
                    rows = []
                last = k
                rows.append((r[0], *(float("nan") if v is None else v for v in r[1:])))
            if len(out) >= 10_000:
                yield pa.RecordBatch.from_pylist([dict(zip(types.names, x, strict=True)) for x in out], schema=types)
                out = []
        if rows:
            out += fused(last, rows)
            yield pa.RecordBatch.from_pylist([dict(zip(types.names, x, strict=True)) for x in out], schema=types)

    nan = F.lit(float("nan"))
    x = df.select(key, id_, *[F.coalesce(F.col(c).cast("double"), nan).alias(c) for c in (low, high, confidence)])
    order = [F.asc(key), (-F.col(confidence)).asc(), F.asc(low), F.asc(high), F.asc_nulls_last(id_)]  # NaN is last
    return x.repartition(key).sortWithinPartitions(*order).mapInArrow(fold, schema)
