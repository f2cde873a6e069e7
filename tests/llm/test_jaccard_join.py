import random
import re

import pytest
from pyspark.sql import functions as F

from plumbline.llm.jaccard_join import jaccard_join


def brute(rows, k, num, den):
    sets = []
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        s = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
        sets.append((i, s))
    root = {i: i for i, _ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, (i, s) in enumerate(sets):
        for j, t in sets[:x]:
            if s and t and None not in (i, j) and den * len(s & t) >= num * len(s | t):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return sorted(((i, len(s), find(i) if i is not None else None) for i, s in sets), key=str)


def texts(seed, n):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    base = [[rng.choice(vocab) for _ in range(rng.choice([3, 5, 9, 30, 60, 75, 90, 200, 400]))] for _ in range(n)]
    passage = [rng.choice(vocab) for _ in range(40)]
    out = []
    for b in base:
        if rng.random() < 0.3:
            b = b + passage
        out.append(" ".join(b))
        for _ in range(rng.choice([0, 0, 1, 2])):
            c = list(b)
            for _ in range(rng.randint(0, max(1, len(c) // 60))):
                c[rng.randrange(len(c))] = rng.choice(vocab)
            out.append(" ".join(c[: len(c) - rng.randint(0, max(0, len(c) // 12))]))
    hot = [rng.choice(vocab) for _ in range(150)]
    for _ in range(170):
        c = list(hot)
        for _ in range(rng.randint(0, 6)):
            c[rng.randrange(len(c))] = rng.choice(vocab)
        out.append(" ".join(c))
    return out + [" ".join(hot)] * 30


@pytest.mark.parametrize("k,num,den", [(4, 85, 100), (5, 80, 100)])
def test_matches_brute_force(spark, k, num, den):
    rows = list(enumerate(texts(3, 150)))
    rows += [(5000, None), (5001, ""), (5002, " \n"), (5003, "One two"), (5004, "one TWO"), (None, "one two"), (5005, "Éa b"), (5006, "éa b")]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, n_shingles string").repartition(5)
    got = sorted([(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join(df, k, num, den).collect()], key=str)
    assert got == brute(rows, k, num, den)


def test_empty_and_repeated_ids(spark):
    assert jaccard_join(spark.createDataFrame([], "doc_id bigint, text string"), 4, 85, 100).count() == 0
    rows = [(1, "a b c d e"), (2, "a b c d e"), (2, "f g h i j"), (3, "f g h i j")]
    got = jaccard_join(spark.createDataFrame(rows, "doc_id bigint, text string"), 4, 85, 100)
    assert [tuple(r) for r in got.orderBy("doc_id", "n_shingles").select("doc_id", "component_id").collect()] == [(1, 1), (2, 1), (2, 1), (3, 1)]
    assert got.where(F.col("n_shingles") != 2).count() == 0
