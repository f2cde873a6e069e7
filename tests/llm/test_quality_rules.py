import random
import re
from collections import Counter

from pyspark.sql import functions as F

from plumbline.llm import quality_rules as qr


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    wins = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    count = Counter(wins)
    hit = set()
    for i, x in enumerate(wins):
        if count[x] > 1:
            hit |= set(range(i, i + 8))
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def texts():
    rng = random.Random(6)
    bits = ["word", "é", "日本", "#", "AB!!", "\n", "\n\n", "  ", "\t", "x<y", "same line\n", "12"]
    out = ["", None, " ", "\n", "\n\na\n\na", "a " * 30, "The " * 3 + "fox"]
    out += [" ".join(rng.choice(bits[: rng.randint(2, len(bits))]) for _ in range(rng.randint(0, 120))) for _ in range(400)]
    return out + [" ".join(f"w{i % 9}" for i in range(20_000))]


def test_measures_match_brute_force(spark):
    rows = list(enumerate(texts())) + [(None, "a b"), (3, "a b"), (3, "a b")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, failed string").repartition(4)
    got = qr.quality_rules(df).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted(((r.doc_id, *[r[n] for n in names]) for r in got), key=str) == sorted(((i, *brute(t)) for i, t in rows), key=str)
    assert all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) for r in got)
    assert all(not (r.base_failed and r.kept) for r in got)


def test_policies_and_ablations_read_bits_only(spark):
    led = spark.createDataFrame([(0,), (1,), (2,), (3,), (4,), (5,), (128,), (128,)], "failed bigint")
    assert [r.kept for r in qr.apply_policy(led, "v1").collect()] == [True, False, False, False, True, False, True, True]
    got = {r.rule: (r.n_failed, r.n_only) for r in qr.ablations(led, "v2").collect()}
    assert got["few_words"] == (3, 1) and got["repeated_words"] == (2, 1) and got["symbols"] == (2, 1) and got["digits"] == (2, 2)
    assert qr.ablations(led.limit(0)).agg(F.sum("n_failed")).first()[0] == 0
