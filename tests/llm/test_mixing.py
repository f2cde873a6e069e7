import random
import re
from collections import defaultdict

import pandas as pd
import pytest

from plumbline.llm.mixing import duel, mix_sources


def targets(size, weights=(3, 1, 2)):
    names = sorted((s for s in size if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in size else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, full = 1.5 * sum(size.values()), set()
    while True:
        free = [s for s in names if s not in full]
        if not free:
            return {s: 2.0 * size[s] for s in names}
        rate = (left - sum(2.0 * size[s] for s in full)) / sum(w[s] for s in free)
        over = [s for s in free if rate * w[s] > 2 * size[s] + 1e-9]
        if not over:
            return {s: 2.0 * size[s] if s in full else rate * w[s] for s in names}
        full |= set(over)


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        source = rng.choice(["a"] * 8 + ["b", "B", "ä", "z", None, "tiny" if i < 600 else "c"])
        rows.append((i, None if rng.random() < 0.01 else " ".join(["w"] * int(rng.lognormvariate(3, 1.2))), source, "x"))
    return rows + [(1, "same row", "b", "x")] * 3 + [(None, "no id", "b", "x"), (7000, "", "empty", "x")]


def test_targets_words_and_reruns(spark, docs):
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string, size string")
    got = mix_sources(df.repartition(7)).collect()
    assert len(got) == len(docs)
    size, count = defaultdict(int), defaultdict(list)
    for i, text, source, _ in docs:
        n = len(re.findall(r"\S+", text or ""))
        size[source] += n
        count[i].append(n)
    want, taken, largest = targets(size), defaultdict(int), defaultdict(int)
    for r in got:
        assert r.size in count[r.doc_id] and 0 <= r.taken <= 2 * r.size
        assert r.source_size == size[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    assert abs(sum(want.values()) - 1.5 * sum(size.values())) < 1e-3
    for s, t in want.items():
        assert abs(taken[s] - t) <= largest[s], s
    again = mix_sources(df.repartition(3)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_duel_keeps_words_and_expectation():
    sizes = [7, 5, 5, 3, 2, 2, 1, 1]
    total = [0.0] * len(sizes)
    for seed in range(3000):
        rows = pd.DataFrame({"key": [str(i) for i in range(len(sizes))], "size": sizes, "p": 0.375})
        out = duel(rows, seed).sort_values("key")
        assert abs((out["p"] * out["size"]).sum() - 0.375 * sum(sizes)) < 1e-6
        assert ((out["p"] > 0) & (out["p"] < 1)).sum() <= 1
        total = [a + b for a, b in zip(total, out["p"])]
    assert all(abs(t / 3000 - 0.375) < 0.04 for t in total)


def test_empty(spark):
    assert mix_sources(spark.createDataFrame([], "doc_id bigint, text string, source string")).count() == 0
    only = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id bigint, text string, source string")
    assert [r.taken for r in mix_sources(only).collect()] == [0, 0]
