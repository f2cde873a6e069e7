import hashlib
import random
import re
import zlib

import numpy as np
from plumbline.llm.tandem_runs import planted, run_digests, runs, tandem_runs


def brute(w):
    """All runs as (start, end, smallest period)."""
    best = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i >= q:
                best.setdefault((i, j + q), q)  # a larger period over the same words is a multiple
            i = max(j, i + 1)
    return sorted((s, e, q) for (s, e), q in best.items())


def digest(i, text, plant):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(w), zlib.crc32(str(i).encode())
    if plant and i is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[j] if j < a else w[a + (j - a) % p] for j in range(n)]
    found = [(s, e - s, q) for s, e, q in brute(w) if e - s >= 12]
    kept = [x for j, x in enumerate(w) if not any(s + q <= j < s + length for s, length, q in found)]
    top = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None,) * 3
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (i, n, len(found), *top, 1000 * top[1] // top[2] if found else None, sha(lines), sha(" ".join(kept)))


def corpus(seed):
    rng = random.Random(seed)
    out = [None, "", " \n", "one", "a " * 11, "a " * 12, "a b " * 6, "same " * 3000]
    for _ in range(250):
        words = [f"w{rng.randrange(rng.choice([2, 3, 40]))}é" for _ in range(rng.choice([5, 20, 60, 150]))]
        for _ in range(rng.choice([0, 1, 2])):
            at, p = rng.randrange(len(words)), rng.randint(1, 9)
            words[at:at] = words[at : at + p] * rng.randint(2, 8) + words[at : at + rng.randint(0, p)]
        if rng.random() < 0.2:
            words += words[: len(words) // 2]
        out.append(rng.choice([" ", "\n", " \t "]).join(words))
    return list(enumerate(out)) + [(8, out[-1]), (None, "x y " * 9)]


def test_runs_of_all_lengths():
    rng = random.Random(4)
    for _ in range(1500):
        w = [rng.randrange(rng.choice([1, 2, 3, 4])) for _ in range(rng.randint(1, 50))]
        s, e, q = runs(np.array([*w, 99]))
        assert sorted(zip(s.tolist(), e.tolist(), q.tolist())) == brute(w)
    for w in ("0" * 300, "01" * 150, "0010010100100101001010" * 9):  # powers, Fibonacci words
        s, e, q = runs(np.array([*map(int, w), 99]))
        assert sorted(zip(s.tolist(), e.tolist(), q.tolist())) == brute(w)


def test_matches_brute_force(spark):
    rows = corpus(1)
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id bigint, text string, runs int, start int").repartition(3)
    for plant in (None, planted):
        got = run_digests(tandem_runs(df, rewrite=plant))
        assert sorted([tuple(r) for r in got.collect()], key=str) == sorted([digest(i, t, plant) for i, t in rows], key=str)


def test_carried_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, "b a b a b a b a b a b a b", [1], "z")], "doc_id bigint, text string, runs array<int>, collapsed string")
    row = tandem_runs(df, carry=("doc_id", "collapsed")).collect()[0]
    assert (row[0], row[1], row[2], [tuple(x) for x in row[3]], row[4]) == (1, "z", 13, [(0, 13, 2)], "b a")


def test_empty_table(spark):
    assert tandem_runs(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
