import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from plumbline.llm.token_counts import Sketch, _merged, build_table, frequent_units, token_counts, units

PATH = public_tokenizers.path("byte_bpe_50k.json")


def texts():
    rng = random.Random(1)
    bits = ["a", "B", " ", "  ", "\n", "\n\n", "\t", "'s", "'", "é", " ", "　", "12", ".", "!!", "<|endoftext|>", "word", "\r\n", "x\x1cy", "\x0b", "日本", "<|", "\x85", " 's", " \n", " "]
    return ["", " ", "\n"] + ["".join(rng.choice(bits) for _ in range(rng.randint(0, 10))) for _ in range(5000)] + ["long words " * 30_000]


def test_counts_are_the_librarys(spark):
    tok = Tokenizer.from_file(PATH)
    rows = list(enumerate(texts())) + [(7, None), (None, "a b"), (7, "a b")]
    want = [(i, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, n_tokens string").repartition(3)
    assert sorted(map(tuple, token_counts(df, PATH).collect()), key=str) == sorted(want, key=str)
    assert sorted(map(tuple, token_counts(df, PATH, frequent=[]).collect()), key=str) == sorted(want, key=str)


def test_sketch_keeps_what_is_frequent():
    rng = np.random.default_rng(3)
    rare = rng.integers(1000, 2**63, 40_000).astype(np.uint64)
    stream = rng.permutation(np.concatenate([np.repeat(np.arange(1, 41, dtype=np.uint64), 900), rare]))
    parts = []
    for part in np.array_split(stream, 7):
        s = Sketch(100)
        for piece in np.array_split(part, 5):
            s.add(*np.unique(piece, return_counts=True))
            assert len(s.keys) <= 100
        parts.append((s.keys.tobytes(), s.counts.tobytes(), (s.keys % np.uint64(7)).astype(np.int32).tobytes()))
    keys, counts, lengths = _merged(iter(parts), 100)
    assert len(keys) <= 100 and set(range(1, 41)) <= set(keys.tolist())
    assert counts.max() <= 900 and (lengths == keys % np.uint64(7)).all()


def test_first_tier_holds_the_documents_frequent_units(spark):
    tok = Tokenizer.from_file(PATH)
    rng = random.Random(2)
    common = [f"zq{i}xk" for i in range(50)]
    rows = [(" ".join(rng.choice(common) if rng.random() < 0.8 else f"r{rng.random()}" for _ in range(200)),) for _ in range(100)]
    docs = spark.createDataFrame(rows + [(None,), ("",), ("z" * 500,)], "text string").repartition(70)  # more than are merged at once
    table = frequent_units(docs, PATH, counters=300)
    raw = "".join(" " + c for c in common).encode()
    got = table.get(units(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[3])
    assert got.tolist() == [len(tok.encode(" " + c).ids) for c in common] and got.min() > 1
    assert (table.counts > 0).sum() <= 300
    assert (frequent_units(docs.limit(0), PATH).counts == 0).all()
    assert (build_table(PATH, []).get(np.array([5], np.uint64)) == 0).all()


def test_nothing_is_shuffled(spark):
    df = spark.createDataFrame([(1, "the cat")], "doc_id bigint, text string")
    plan = token_counts(df, PATH)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert token_counts(df.limit(0), PATH).count() == 0
