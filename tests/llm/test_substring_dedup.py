import hashlib
import random
import re

import pytest

from plumbline.llm.substring_dedup import FingerprintIndex, removed_words, substring_dedup


def brute(rows):
    first = {}
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    for i, w in split:
        for j in range(len(w) - 12):
            k = tuple(w[j : j + 13])
            if i is not None:
                first[k] = min(i, first.get(k, i))
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for j in range(len(w) - 12):
            if i is not None and first[tuple(w[j : j + 13])] < i:
                gone[j : j + 13] = [True] * 13
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}é" for i in range(60)]
    passages = [[rng.choice(vocab) for _ in range(rng.choice([12, 13, 14, 20, 60]))] for _ in range(12)]
    docs = []
    for _ in range(150):
        w = [rng.choice(vocab) for _ in range(rng.choice([0, 5, 12, 13, 14, 40, 120]))]
        for _ in range(rng.choice([0, 1, 2])):
            p = rng.choice(passages)
            at = rng.randint(0, len(w))
            w[at:at] = p[rng.randint(0, 3) :]
        docs.append(w)
        if rng.random() < 0.3:
            c = list(rng.choice(docs))
            for _ in range(rng.randint(0, 4)):
                if c:
                    c[rng.randrange(len(c))] = rng.choice(vocab)
            docs.append(c)
    docs.append(["same"] * 40)
    docs.append(["same"] * 14)
    return [rng.choice([" ", "\n", " \t"]).join(w) for w in docs]


@pytest.mark.parametrize("batches", [1, 2, 3])
def test_matches_brute_force(spark, batches):
    rows = list(enumerate(corpus(batches))) + [(9000, None), (9001, ""), (None, "a " * 20), (9002, "a " * 20), (9003, "a " * 20), (9003, "b " * 20)]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id bigint, text string, entry int").repartition(5)
    got = substring_dedup(df, batches).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(rows)


def test_empty_table_and_order(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert substring_dedup(empty).count() == 0
    index = FingerprintIndex(spark)
    index.add(spark.createDataFrame([(5, "x " * 20)], "doc_id bigint, text string"))
    with pytest.raises(ValueError):
        index.add(spark.createDataFrame([(5, "x " * 20)], "doc_id bigint, text string"))


def test_runs_are_compacted_and_reopened(spark, tmp_path):
    rows = list(enumerate(corpus(5)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    edges = [0, 20, 40, 60, 80, 100, 120, 10_000]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        index = FingerprintIndex.open(spark, f"{tmp_path}/i") if a else FingerprintIndex(spark, f"{tmp_path}/i", buckets=3)
        index.add(df.where((df.doc_id >= a) & (df.doc_id < b)))
        assert index.buckets == 3
    assert len(index.runs) < 7 and any(f.startswith("run-") for f, _ in index.runs)
    got = removed_words(df, FingerprintIndex.open(spark, f"{tmp_path}/i").flags).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(rows)


def test_hot_anchor_and_copies(spark):
    rng = random.Random(6)
    phrase = [f"p{i}" for i in range(12)]  # no whole window: every document has groups of its own around it
    rows = [(i, " ".join([f"a{rng.randrange(9)}", *phrase, f"b{rng.randrange(40)}", *(f"c{rng.randrange(6)}" for _ in range(8))])) for i in range(400)]
    rows += [(i, "the very same words in all of these documents and some more of them here") for i in range(400, 700)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    got = substring_dedup(df).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(rows)


def test_columns_named_as_the_working_ones(spark):
    rows = [(i, "the very same words in all of these documents and some more of them here", 1, "a", 2) for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, __check0 int, __full0 string, __again0 int")
    got = {r.doc_id: (r.n_removed, r["__check0"], r["__full0"], r["__again0"]) for r in substring_dedup(df).collect()}
    assert got == {0: (0, 1, "a", 2), 1: (15, 1, "a", 2), 2: (15, 1, "a", 2)}
