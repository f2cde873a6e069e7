"""Operators that must not look at all pairs, against all pairs."""

import numpy as np
from pyspark.sql import functions as F

from plumbline.operators import joins


def test_nearest_within_matches_all_pairs(spark):
    rng = np.random.default_rng(5)
    a = np.concatenate([np.round(rng.uniform(-5, 5, 300), 1), [0.0, 9.0, -1e-20, np.nan, np.inf]])
    b = np.concatenate([np.round(rng.uniform(-3, 5, 60), 1), [1.0, 1.0, -1.0, np.nan]])
    left = spark.createDataFrame([(i, float(v)) for i, v in enumerate(a)] + [(999, None)], "i int, v double")
    right = spark.createDataFrame([(j, float(w)) for j, w in enumerate(b)] + [(999, None)], "j int, w double")
    got = {r.i: r.j for r in joins.nearest_within(left, "i", F.col("v"), right, "j", F.col("w"), 0.3).collect()}
    want = {i: min((abs(w - v), j) for j, w in enumerate(b) if abs(w - v) <= 0.3)[1] for i, v in enumerate(a) if any(abs(w - v) <= 0.3 for w in b)}
    assert got == want
    wide = {r.i: r.j for r in joins.nearest_within(left, "i", F.col("v"), right, "j", F.col("w"), 100.0).collect()}
    assert wide == {i: min((abs(w - v), j) for j, w in enumerate(b) if abs(w - v) <= 100)[1] for i, v in enumerate(a) if np.isfinite(v)}


def test_opposing_faces_match_all_pairs(spark):
    rng = np.random.default_rng(7)
    rows = [(int(i), "ab"[rng.integers(2)], float(rng.integers(6)), float(rng.integers(3)), float(rng.integers(3, 6))) for i in rng.integers(0, 150, 200)] + [(300, None, 0.0, 0.0, 1.0), (301, "a", None, 0.0, 9.0), (302, "a", 2.0, None, 4.0), (303, "a", 3.0, 0.0, None)]
    df = spark.createDataFrame(rows, "id int, g string, o double, lo double, hi double")
    least = lambda a, b: b if a is None else a if b is None else min(a, b)  # noqa: E731 - as SQL has it
    most = lambda a, b: b if a is None else a if b is None else max(a, b)
    for low, high in ((1.0, 2.0), (0.0, 1.0)):
        want: dict[int, tuple] = {}
        for i, g, o, lo, hi in rows:
            for j, g2, o2, lo2, hi2 in rows:
                if i == j or g is None or g != g2 or o is None or o2 is None or not low <= abs(o - o2) <= high:
                    continue
                minus = lambda a, b: None if a is None or b is None else a - b
                if least(hi, hi2) - most(lo, lo2) >= max(0.25, 0.25 * (least(minus(hi, lo), minus(hi2, lo2)) or 0)):
                    want[i] = min(want.get(i, (99.0, 0)), (abs(o - o2), j))
        got = {r.id: (r.separation, r.other) for r in joins.opposing(df, "id", "g", "o", ("lo", "hi"), low, high, 0.25).collect()}
        assert got == want


def test_opposing_faces_compare_classes_only(spark):
    """60,000 equal faces on either side: 3.6 thousand million pairs of faces, two classes."""
    df = spark.range(120_000).selectExpr("id", "'g' as g", "double(id % 2) as o", "0d as lo", "1d as hi")
    got = joins.opposing(df, "id", "g", "o", ("lo", "hi"), 1.0, 2.0, 0.25)
    assert got.count() == 120_000 and got.where("other <> (id + 1) % 2").isEmpty()


def test_shared_area_of_rectangles_is_exact():
    """63/128 of a room: by triangles it came out a little less, and its seventh decimal is a five."""
    from plumbline.operators.rooms import overlap_area

    box = lambda x0, y0, x1, y1: np.array([(x0, y0), (x1, y0), (x1, y1), (x0, y1)])
    rng = np.random.default_rng(1)
    for _ in range(400):
        x0, y0, u0, v0 = rng.integers(-40, 40, 4) / 4
        w, h, p, q = 2 + rng.integers(0, 60, 4) / 4
        want = max(0.0, min(x0 + w, u0 + p) - max(x0, u0)) * max(0.0, min(y0 + h, v0 + q) - max(y0, v0))
        assert overlap_area(box(x0, y0, x0 + w, y0 + h), box(u0, v0, u0 + p, v0 + q)[::-1]) == want
    notched = np.array([(0, 0), (4, 0), (4, 4), (2, 1), (0, 4)], dtype=float)
    assert abs(overlap_area(notched, box(0, 0, 4, 4)) - 10) < 1e-9
    star = np.array([(np.sin(a), np.cos(a)) for a in np.arange(5) * 4 * np.pi / 5])  # turns left only, but twice round
    assert overlap_area(star, box(-2, -2, 2, 2)) < 4


def test_sharpest_neighbour_weighs_ids_as_its_sql(spark, tmp_path):
    """Ids far apart outweigh a small difference of values, as value * 1e7 - id has it."""
    import duckdb

    from plumbline.plans import series

    duckdb.sql("copy (select (k * 40000000)::bigint as event_id, timestamp '2024-01-01' as ts, (k % 2)::bigint as user_id, 'view' as event_type, case when k % 11 > 0 then 3 + (k * 7 % 5) end::double as value, '{}' as props from range(60) r(k)) to '" + str(tmp_path / "events.parquet") + "'")
    got = sorted(map(tuple, series.sharpest_neighbour(spark, str(tmp_path)).select("track", "id", "sharpest").collect()))
    c = duckdb.connect()
    c.execute(f"create view events as select * from read_parquet('{tmp_path}/events.parquet')")
    assert got == sorted(c.execute(series.ORACLES["sharpest_neighbour"]).fetchall())


def test_sums_in_any_order_tie(spark):
    from plumbline.operators import evidence

    rows = [(k, c, w) for k in (1, 2) for c, ws in (("b", (0.1, 0.2, 0.3)), ("a", (0.3, 0.2, 0.1))) for w in (ws if k == 1 else ws[::-1])]
    df = spark.createDataFrame(rows, "k int, v string, w double").coalesce(1)
    assert {(r.top, r.second) for r in evidence.dominant_class(df, "k", "v", F.col("w")).collect()} == {("a", "b")}


def test_dominant_class_of_odd_votes_as_its_sql(spark, tmp_path):
    """Null classes, weights of 1e-10, sums one bit apart, infinite and missing weights, in any order of rows."""
    import duckdb

    from plumbline.plans import space

    votes = {
        1: [(None, 0.1)], 2: [("R", 0.1), (None, 0.1)], 3: [(None, 0.0), ("A", 0.9)], 4: [("A", 1 - 1e-10), ("R", 1 - 4e-10)], 5: [("A", 0.9), ("A", 0.8), ("R", 0.7)],
        6: [("A", float("nan")), ("R", -4.0)], 7: [("A", float("-inf")), ("R", 0.0)], 8: [("A", None), ("R", 0.5)], 9: [("A", None), (None, None)], 10: [("N", 0.0), ("A", 0.4)], None: [("R", 0.2), ("", 0.2)],
    }
    rows = [(k, n, 1.0, 0.1, w, c) for k, vs in votes.items() for n, (c, w) in enumerate(vs)]
    spark.createDataFrame(rows, "l_suppkey bigint, l_orderkey bigint, l_quantity double, l_tax double, l_discount double, l_returnflag string").write.parquet(str(tmp_path / "lineitem.parquet"))
    got = sorted(map(tuple, space.dominant_class(spark, str(tmp_path)).collect()), key=str)
    c = duckdb.connect()
    c.execute(f"create view lineitem as select * from read_parquet('{tmp_path}/lineitem.parquet/*.parquet')")
    assert got == sorted(c.execute(space.ORACLES["dominant_class"]).fetchall(), key=str)
    assert len(got) == 11


def test_probed_labels_are_not_broadcast(spark):
    from plumbline.plans import outlines

    plan = outlines.probed_walls(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan


def _clumps(spark):
    """Dense clumps at distances about the radius, copies of places, lone points and points that are none."""
    rng = np.random.default_rng(11)
    p = np.concatenate([rng.normal(0, 0.03, (120, 3)), rng.normal(0, 0.02, (60, 3)) + [0.33, 0, 0], rng.uniform(-1, 1, (60, 3))])
    p = np.concatenate([p, p[:20], p[190:200]])
    q = rng.normal(size=p.shape)
    rows = [(i, *map(float, x), *map(float, y)) for i, (x, y) in enumerate(zip(p, q, strict=True))]
    return p, q, spark.createDataFrame(rows + [(900, None, 0.0, 0.0, 1.0, 0.0, 0.0), (901, float("nan"), 0.0, 0.0, 1.0, 0.0, 0.0)], "id long, x double, y double, z double, nx double, ny double, nz double")


def test_near_operators_match_all_pairs(spark):
    p, q, df = _clumps(spark)
    n = len(p)
    dist = np.sqrt(((p[:, None] - p[None]) ** 2).sum(-1))
    np.fill_diagonal(dist, np.inf)
    got = {r.i: r.distance for r in joins.nearest_other(df, "id", ["x", "y", "z"], 0.3).collect()}
    assert set(got) == {i for i in range(n) if dist[i].min() < 0.3}
    assert all(abs(got[i] - dist[i].min()) < 1e-12 for i in got)
    for radius in (0.02, 0.12, 0.3):
        label = np.arange(n)
        while True:
            low = np.minimum(label, np.where(dist < radius, label[None], n).min(1))
            if (low == label).all():
                break
            label = low
        found = {r.id: r.label for r in joins.near_components(df, "id", ["x", "y", "z"], radius).collect()}
        assert found == {**dict(enumerate(label)), 900: 900, 901: 901}
    u = q / np.linalg.norm(q, axis=1)[:, None]
    want = sorted((dist[i, j], i, j) for j in range(n) for i in range(j - 4) if dist[i, j] < 0.3 and u[i] @ u[j] >= 0.34)
    for limit in (7, 100_000):
        best = [(r.i, r.j) for r in joins.loop_candidates(df, "id", ["x", "y", "z"], ["nx", "ny", "nz"], 0.3, 4, 0.34, limit).collect()]
        assert best == [(i, j) for _, i, j in want[:limit]]


def test_copies_of_a_place_cost_no_pairs(spark):
    """100,000 rows at two places: their pairs would be five thousand million."""
    df = spark.range(100_000).selectExpr("id", "0.1 * (id % 2) as x", "0d as y", "0d as z", "1d as nx", "0d as ny", "0d as nz")
    xyz = ["x", "y", "z"]
    assert joins.near_components(df, "id", xyz, 0.12).where("label <> 0").isEmpty()
    assert joins.nearest_other(df, "id", xyz, 0.5).where("distance = 0").count() == 100_000
    best = joins.loop_candidates(df, "id", xyz, ["nx", "ny", "nz"], 0.3, 4, 0.34, 5).collect()
    assert [(r.i, r.j, r.distance) for r in best] == [(0, j, 0.0) for j in (6, 8, 10, 12, 14)]


def test_greedy_fusion_makes_no_frame_a_key(spark):
    """Groups as the head rule has them, nulls last, keys that follow one another over many batches."""
    from plumbline.operators import folds

    rows = [(k, i, float(v), float(v) + 0.4, c) for k in (None, 1, 2) for i, (v, c) in enumerate([(0.0, 0.2), (0.3, 0.9), (0.6, 0.5), (2.0, None)])]
    df = spark.createDataFrame(rows, "k int, id long, lo double, hi double, c double")
    out = folds.fuse_intervals(df, "k", "lo", "hi", "c", "id")
    assert "ArrowInPandas" not in (plan := out._jdf.queryExecution().toString()) and "GroupsInPandas" not in plan
    got = sorted((str(r.k), r.head, r.n) for r in out.collect())
    assert got == sorted((k, h, n) for k in ("None", "1", "2") for h, n in ((1, 3), (3, 1)))


def test_rings_are_not_broadcast(spark):
    """Files of rings are small and their rows wide: 218 MB were broadcast of 195,000 half edges."""
    from plumbline.operators import rings

    rows = [(f"{g}-{i:02}", f"{g}-{(i + 7) % n:02}") for g, n in (("a", 10), ("b", 1), ("c", 36)) for i in range(n)]
    out = rings.ring_order(spark.createDataFrame(rows, "id string, next string").repartition(3))
    assert "BroadcastExchange" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r.id: (r.ring, r.place) for r in out.collect()}
    assert got == {f"{g}-{i * 7 % n:02}": (f"{g}-00", i) for g, n in (("a", 10), ("b", 1), ("c", 36)) for i in range(n)}
