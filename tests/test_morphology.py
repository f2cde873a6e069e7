"""Dilation and erosion of tiles against sets of cells."""

import numpy as np

from plumbline.operators import grids


def _dilated(cells, r):
    return {(k, u + a, v + b) for k, u, v in cells for a in range(-r, r + 1) for b in range(-r, r + 1)}


def _eroded(cells, r):
    return {(k, u, v) for k, u, v in cells if all((k, u + a, v + b) in cells for a in range(-r, r + 1) for b in range(-r, r + 1))}


def test_morphology_matches_sets(spark):
    rng = np.random.default_rng(2)
    cells = {(int(k), int(u), int(v)) for k, u, v in zip(rng.integers(0, 2, 900), rng.integers(-13, 13, 900), rng.integers(-13, 13, 900), strict=True)}
    cells |= {(None, u, v) for u in range(-9, 9) for v in range(-17, -6)} | {(5, 10**12, -(10**12)), (5, 0, 7)}
    df = spark.createDataFrame([*cells, *list(cells)[:50]], "k int, cu long, cv long")
    for r in (0, 1, 2):
        want = {"dilate": _dilated(cells, r), "erode": _eroded(cells, r), "close": _eroded(_dilated(cells, r), r), "opened": _dilated(_eroded(cells, r), r)}
        for name, cs in want.items():
            got = [tuple(x) for x in getattr(grids, name)(df, ["k"], r).select("k", "cu", "cv").collect()]
            assert len(got) == len(set(got)) and set(got) == cs, (name, r)


def test_steps_make_few_rows(spark):
    """A block of 512 by 512 cells is 4096 tiles: closing it must not make nine rows a cell."""
    df = spark.range(512 * 512).selectExpr("id div 512 as cu", "id % 512 as cv")
    tiles = grids._stepped(grids._stepped(grids._tiles(df, []), [], 1, False), [], 1, True)
    assert tiles.count() == 64 * 64
    plan = grids.close(df, [])._jdf.queryExecution().optimizedPlan().toString()
    assert "[-1,0,1]" not in plan
    assert grids.close(df, []).count() == 512 * 512


def test_opening_makes_few_rows(spark):
    """grid_open's step, an opening after a dilation, on a block with a gap and a lone cell."""
    block = {(None, u, v) for u in range(40) for v in range(40)} - {(None, 20, 20)} | {(None, 90, 90)}
    df = spark.createDataFrame([(u, v) for _, u, v in block], "cu long, cv long")
    out = grids.opened(grids.dilate(df, []), [])
    assert "[-1,0,1]" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {(None, r.cu, r.cv) for r in out.collect()} == _dilated(_eroded(_dilated(block, 1), 1), 1)


def test_opening_widened_cells_matches_sets(spark):
    rng = np.random.default_rng(6)
    cells = {(int(k), int(u), int(v)) for k, u, v in zip(rng.integers(0, 3, 300), rng.integers(-13, 13, 300), rng.integers(-13, 13, 300), strict=True)} | {(None, 7, 8)}
    df = spark.createDataFrame([*cells, *list(cells)[:50], (1, None, 0), (1, 0, None)], "k int, cu long, cv long")
    for widened, r in ((0, 1), (1, 0), (1, 1), (2, 1), (1, 2)):
        got = [tuple(x) for x in grids.opened(df, ["k"], r, widened).select("k", "cu", "cv").collect()]
        assert len(got) == len(set(got)) and set(got) == _dilated(_eroded(_dilated(cells, widened), r), r), (widened, r)


def test_grid_open_stays_in_tiles(spark):
    """Tiles become cells once, at the end; a step's parts are merged behind its shuffle only, one shuffle an axis."""
    from plumbline.plans import space

    for query, steps in ((space.grid_dilate, 1), (space.grid_close, 2), (space.grid_open, 3)):
        plan = query(spark, "/root/testdata/sf0.001")._jdf.queryExecution()
        assert plan.optimizedPlan().toString().count("Generate explode(filter(") == 1, query
        assert plan.executedPlan().toString().count("Exchange hashpartitioning(") == 1 + 2 * steps, query
        assert plan.optimizedPlan().toString().count("RepartitionByExpression") == 2 * steps, query
