import numpy as np

from plumbline.llm.embedding_dedup import embedding_dedup


def brute(ids, vecs, t=0.95):
    ok = [v is not None and None not in v and len(v) and np.isfinite(v).all() and np.any(np.array(v, np.float32)) for v in vecs]
    x = np.array([np.array(v, np.float32) if o else np.zeros(16) for v, o in zip(vecs, ok)], np.float64)
    n = np.linalg.norm(x, axis=1)
    n[n == 0] = 1
    near = (x / n[:, None]) @ (x / n[:, None]).T >= t
    np.fill_diagonal(near, False)
    label = np.array(ids)
    while True:
        new = np.array([min([label[i], *label[near[i]]]) for i in range(len(ids))])
        if (new == label).all():
            return {i: (int(near[k].sum()), int(label[k])) for k, i in enumerate(ids)}
        label = new


def test_matches_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((300, 16))
    rows = [list(v) for v in base]
    for i in range(150):
        v = base[i % 40]
        rows.append(list(v * rng.uniform(0.5, 2) + rng.standard_normal(16) * rng.choice([0.02, 0.1, 0.3])))
    rows += [list(base[0])] * 30 + [list(base[1] + rng.standard_normal(16) * 0.05) for _ in range(700)]
    rows += [None, [0.0] * 16, [float("nan")] * 16, [None] + [1.0] * 15, [], [float("inf")] + [0.0] * 15]
    ids = rng.permutation(5000)[: len(rows)].tolist()
    df = spark.createDataFrame([(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v], 1) for i, v in zip(ids, rows)], "vec_id bigint, embedding array<float>, kept int").repartition(5)
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup(df).collect()}
    want = brute(ids, rows)
    assert len(got) == len(want) == len(rows)
    linked = [i for i, (n, _) in want.items() if n]
    assert np.mean([got[i] == want[i] for i in linked]) >= 0.98
    assert all(got[i][0] <= want[i][0] for i in ids)
    assert all(got[i] == (0, i) for i, v in zip(ids[-6:], rows[-6:]))


def test_empty_and_null_ids(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert embedding_dedup(spark.createDataFrame([], schema)).count() == 0
    got = embedding_dedup(spark.createDataFrame([(None, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 0.0]), (4, [1.0])], schema))
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(None, 0, None, True), (2, 2, 2, True), (2, 2, 2, True), (3, 2, 2, False), (4, 0, 4, True)], key=str)


def test_hot_cluster(spark):
    rng = np.random.default_rng(5)
    n, dim = 12_000, 64
    unit = lambda v: v / np.linalg.norm(v, axis=-1, keepdims=True)
    x = unit(rng.standard_normal((n, dim)))
    hot = 9_000  # cosines around 0.9 to each other, nearly all below the threshold
    x[:hot] = unit(0.9**0.5 * x[-1] + 0.1**0.5 * x[:hot])
    for i in range(0, 600, 2):
        side = rng.standard_normal(dim)
        x[i + 1] = 0.951 * x[i] + (1 - 0.951**2) ** 0.5 * unit(side - (side @ x[i]) * x[i])
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.astype(np.float32).tolist())], "vec_id bigint, embedding array<float>").repartition(4)
    of = {r.vec_id: r.component_id for r in embedding_dedup(df).collect()}
    assert np.mean([of[i] == of[i + 1] for i in range(0, 600, 2)]) >= 0.995


def test_vectors_of_other_numbers(spark):
    for kind in ("array<decimal(6,2)>", "array<int>"):
        df = spark.sql(f"select id as vec_id, cast(e as {kind}) as embedding from values (1, array(1, 0)), (2, array(1, 0)), (3, array(0, 1)), (4, array(2, 0)), (5, cast(null as array<int>)) t(id, e)")
        got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup(df).collect()}
        assert got == {1: (2, 1), 2: (2, 1), 3: (0, 3), 4: (2, 1), 5: (0, 5)}
