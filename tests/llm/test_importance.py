import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from plumbline.llm import importance as imp


def rows():
    rng = random.Random(8)
    good, bad = [f"g{i}" for i in range(50)], [f"b{i}" for i in range(50)]
    out = [(i, " ".join(rng.choice(good if i % 3 else bad) for _ in range(rng.randint(0, 40)))) for i in range(900)]
    return out + [(2000, None), (2001, ""), (None, "g1 g2"), (5, out[5][1])]


def test_ratios_and_top_k_match_brute_force(spark):
    data = rows()
    docs = spark.createDataFrame([(i, t, 0.0) for i, t in data], "doc_id bigint, text string, key double").repartition(4)
    target = spark.createDataFrame([(i,) for i in range(0, 300) if i % 3], "doc_id bigint")
    got = imp.importance_resample(docs, target, 0.6).collect()
    # brute force over the same hash buckets, document by document
    raw, aim, bags = Counter(), Counter(), []
    for i, t in data:
        b = (t or "").encode()
        bucket, _ = imp.features(np.frombuffer(b, np.uint8), np.array([0, len(b)]))
        bags.append(bucket.tolist())
        raw.update(bags[-1])
        if i is not None and i < 300 and i % 3:
            aim.update(bags[-1])
    n = imp.BUCKETS
    ratio = lambda k: math.log((aim[k] + 1) / (sum(aim.values()) + n)) - math.log((raw[k] + 1) / (sum(raw.values()) + n))
    want = sorted((str(i), len(b), round(sum(map(ratio, b)), 6)) for (i, _), b in zip(data, bags))
    assert sorted((str(r.doc_id), r.n_grams, round(r.log_ratio, 6)) for r in got) == want
    order = sorted(got, key=lambda r: (-r.key, r.doc_id is not None, r.doc_id or 0))
    k = round(0.6 * len(got))
    assert {str(r) for r in order[:k]} <= {str(r) for r in got if r.kept}
    assert sum(r.kept for r in got) in (k, k + 1)  # one document is there twice
    again = imp.importance_resample(docs.repartition(7), target, 0.6).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_kth_largest(spark):
    rng = random.Random(1)
    keys = [rng.choice([rng.gauss(0, 1), 0.25]) for _ in range(6000)]
    df = spark.createDataFrame(list(enumerate(keys)), "doc_id bigint, key double")
    order = sorted(enumerate(keys), key=lambda x: (-x[1], x[0]))
    old, imp.SORTED = imp.SORTED, 50
    try:
        for k in (1, 10, 2500, 4000, 5999):
            key, doc = imp.kth_largest(df, k)
            assert (key, doc) == (order[k - 1][1], order[k - 1][0])
    finally:
        imp.SORTED = old


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert imp.importance_resample(none, none.select("doc_id")).count() == 0
    one = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    assert imp.importance_resample(one, none.select("doc_id"), 1.0).where(F.col("kept")).count() == 1
