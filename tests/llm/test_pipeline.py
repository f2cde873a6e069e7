import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from plumbline.llm.mixing import mix_sources
from test_jaccard_join import brute as near_brute
from test_quality_rules import brute as quality_brute


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(3)
    vocab = [f"word{i}" for i in range(300)]
    passage = " ".join(rng.choice(vocab) for _ in range(60))
    rows = []
    for i in range(150):
        t = " ".join(rng.choice(vocab) for _ in range(rng.choice([5, 40, 100, 200])))
        rows.append(t + " " + passage if i % 7 == 0 else t)
        if i % 5 == 0:
            rows.append(t + " extra")
        if i % 11 == 0:
            rows.append("AB!! " * 40)
    docs = [(i, t, "en", f"s{i % 4}" if i % 9 else None, len(t)) for i, t in enumerate(rows)] + [(9000, None, None, None, None), (9001, "", "en", "s1", 0)]
    path = str(tmp_path_factory.mktemp("data"))
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3).write.parquet(f"{path}/documents.parquet")
    return path


def test_stages_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    was = [(r.doc_id, r.text) for r in docs.collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == list(stages) and len(stages) == 5
    good = stages["quality rules"](spark, docs, folder)
    kept = {r.doc_id for r in good.collect()}
    for i, t in was:
        n, chars, symbols, dup, repeat = quality_brute(t)
        base = n < 20 or 100 * repeat > 30 * n
        assert not (base and i in kept)
        shout = 100 * (t or "").count("!") > 20 * n or 100 * sum("A" <= c <= "Z" for c in t or "") > 50 * chars
        stutter = 100 * sum(a == b for a, b in zip((t or "").split(), (t or "").split()[1:])) > 30 * n
        assert (i in kept) == (not (base or 100 * symbols > 10 * n or 2 * n > chars or chars > 15 * n or shout or stutter))
    one = stages["n-gram Jaccard join"](spark, good, folder)
    want = {i for i, _, c in near_brute([x for x in was if x[0] in kept], 5, 80, 100) if i == c}
    assert {r.doc_id for r in one.collect()} == want and one.columns == docs.columns
    cut = stages["substring dedup"](spark, one, folder)
    first, texts = set(), {r.doc_id: r.text for r in cut.collect()}
    for i, t in sorted(x for x in was if x[0] in want):
        w = t.split()
        gone = set()
        for j in range(len(w) - 12):
            if tuple(w[j : j + 13]) in first:
                gone |= set(range(j, j + 13))
        first |= {tuple(w[j : j + 13]) for j in range(len(w) - 12)}
        left = " ".join(x for j, x in enumerate(w) if j not in gone)
        assert texts.get(i, "") == (left if gone else t)
    mixed = stages["mixing sources"](spark, cut, folder)
    count = Counter(r.doc_id for r in mixed.collect())
    assert set(count) <= set(texts) and max(count.values()) <= 2 and mixed.columns == docs.columns
    size = {r.doc_id: (r.source, len(r.text.split())) for r in cut.collect()}
    out, target = Counter(), {r.source: r.target for r in mix_sources(cut).select("source", "target").distinct().collect()}
    for i, n in count.items():
        out[size[i][0]] += n * size[i][1]
    assert all(abs(out[s] - target[s]) <= max(n for _, n in size.values()) for s in target)
    ids = stages["SentencePiece encoding"](spark, mixed, folder).collect()
    assert Counter(r.doc_id for r in ids) == count and all(r.n_tokens == len(r.ids) > 0 for r in ids)


def test_mixing_keeps_the_mix_of_repeated_rows(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    more = docs.unionByName(docs).unionByName(docs.withColumn("text", F.concat("text", F.lit(" more words here"))))
    out = stages()["mixing sources"](spark, more, folder)
    words = lambda df: {r.source: r.w for r in df.groupBy("source").agg(F.sum(F.size(F.filter(F.split("text", r"\s+"), lambda x: x != ""))).alias("w")).collect()}
    got, largest = words(out), 210
    target = {r.source: r.target for r in mix_sources(more).select("source", "target").distinct().collect()}
    assert set(got) == set(target) and all(abs(got[s] - target[s]) <= largest for s in target)
    assert out.groupBy("doc_id", "source", "text").count().agg(F.max("count")).first()[0] <= 4


def stages():
    return dict(corpus_pipeline.STAGES)


def test_run_is_repeatable(spark, folder):
    a, b = (sorted((r.doc_id, tuple(r.ids)) for r in corpus_pipeline.run(spark, folder).collect()) for _ in range(2))
    assert a == b and a


def test_empty_table(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
