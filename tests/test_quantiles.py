"""Quantiles by slices against Spark's percentile and the SQL, and how much one task sees of them."""

import numpy as np
from pyspark.sql import functions as F

from plumbline.operators import evidence
from plumbline.operators.quantiles import quantiles

SHARES = [0.0, 0.1, 0.25, 0.5, 0.9, 1 / 3, 1.0]


def test_quantiles_match_percentile(spark):
    rng = np.random.default_rng(3)
    v = np.concatenate([rng.normal(0, 1e3, 900), np.round(rng.normal(0, 1, 500), 1), np.full(300, 0.5), [0.0, -0.0, 1e300, -1e-300, np.inf, np.nan, np.nan]])
    rows = [(int(i % 3), float(x), int(i % 4)) for i, x in enumerate(v)] + [(0, None, 3), (9, None, 1), (7, 4.5, 1), (8, 1.0, 1), (8, 2.0, 2)]
    df = spark.createDataFrame(rows, "k int, x double, w int").repartition(5)
    exact = F.percentile("x", F.array(*map(F.lit, SHARES)))
    text = lambda q: [f"{a + 0.0:.12g}" for a in q]
    got = {r.k: text(r.q) for r in quantiles(df, ["k"], "x", SHARES).collect()}
    assert got == {r.k: text(r.q) for r in df.groupBy("k").agg(exact.alias("q")).where("q is not null").collect()} and 9 not in got
    assert text(quantiles(df, [], "x", SHARES).first().q) == text(df.agg(exact.alias("q")).first().q)
    weighted = F.percentile("x", F.array(*map(F.lit, SHARES)), F.col("w"))
    some = df.where("w > 0")
    assert {r.k: text(r.q) for r in quantiles(some, ["k"], "x", SHARES, "w").collect()} == {r.k: text(r.q) for r in some.groupBy("k").agg(weighted.alias("q")).where("q is not null").collect()}


def test_quantile_trend_gathers_no_values_in_a_task(spark):
    """200,000 different values: no shuffle with one partition brings more than slices' sums to a task."""
    df = spark.range(200_000).selectExpr("id * 7919 % 200003 * 0.5 as x", "double(id % 50) as y")
    out = evidence.quantile_trend(df, "x", "y", 12, 200)
    assert "percentile" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = sorted(map(tuple, out.collect()))
    edges = [(200_000 - 1) * i / 12 for i in range(13)]
    x = np.sort([i * 7919 % 200003 * 0.5 for i in range(200_000)])
    at = lambda p: x[int(p)] + (p - int(p)) * (x[min(int(p) + 1, len(x) - 1)] - x[int(p)])
    e = [at(p) for p in edges]
    assert [(b, n) for b, _, _, n in got] == [(i + 1, int(((x >= e[i]) & (x < e[i + 1])).sum())) for i in range(12)]
    assert all(abs(m - np.median(x[(x >= e[b - 1]) & (x < e[b])])) < 1e-6 for b, m, _, _ in got)


def test_quantile_trend_of_nulls(spark):
    """Rows without x are of no bin above 0; without any x there is no bin."""
    rows = [(float(i), float(i % 4)) for i in range(40)] + [(None, 3.0)] * 5
    df = spark.createDataFrame(rows, "x double, y double")
    got = {r.bin: (r.x, r.y, r.n) for r in evidence.quantile_trend(df, "x", "y", 4, 1).collect()}
    assert got[0] == (None, 3.0, 5) and sum(n for _, _, n in got.values()) == 44
    assert evidence.quantile_trend(df.where("x is null"), "x", "y", 4, 1).collect() == []
