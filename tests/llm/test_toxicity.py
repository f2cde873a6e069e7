import random
import zlib

import numpy as np

from plumbline.llm.toxicity import BUCKETS, SPAN, Model, Scorer, toxicity, train, word_buckets


def corpus(n):
    rng = random.Random(2)
    clean = ["river", "stone", "gentle", "morning", "paper", "window", "garden", "simple", "number", "travel"]
    rows = []
    for i in range(n):
        w = [rng.choice(clean) + rng.choice(["", "s", "ly"]) for _ in range(rng.randint(5, 150))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(max(1, len(w) // 20)):
                w[rng.randrange(len(w))] = rng.choice(["idi0t", "idiott", "iddiot", "idiotic", "morron", "moronn", "m0ron", "idiot", "moron"])
        rows.append((i, " ".join(w), int(toxic)))
    return rows


def test_learns_misspellings_on_held_out_rows(spark):
    rows = corpus(800)
    docs = spark.createDataFrame([(i, t, 1) for i, t, _ in rows] + [(5000, None, 1), (5001, "", 1), (None, "idiot idiot", 1), (3, rows[3][1], 1), (5002, "unseen idiooot " + "river " * 3000, 1), (5003, "river " * 3000, 1)], "doc_id bigint, text string, score int").repartition(3)
    # rows that are held out carry wrong labels: they must not be learned from
    labels = spark.createDataFrame([(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, _, y in rows] + [(None, 1), (4, None)], "doc_id bigint, toxic int")
    got = toxicity(docs, labels).collect()
    assert len(got) == len(rows) + 6
    truth = {i: y for i, _, y in rows}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got if r.doc_id is not None)
    assert len(held) > 200 and sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert [r.predicted for r in got if r.doc_id is None] == [1]
    by = {r.doc_id: r.score for r in got}
    assert by[5002] > 20 * by[5003]  # an unseen misspelling in thousands of clean words shows
    assert sorted(map(str, toxicity(docs.repartition(5), labels).collect())) == sorted(map(str, got))


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert [r.score for r in toxicity(docs, none).collect()] == [0.5]
    assert toxicity(docs.limit(0), none).count() == 0


def test_predicts_a_distant_misspelling(spark):
    rows = corpus(800)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(5002, "unseen idiooot " + "river " * 3000)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int")
    assert toxicity(docs, labels).where("doc_id = 5002").first().predicted == 1


def test_conflicting_labels_in_any_order(spark):
    rows = corpus(200)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    labels = [(i, y) for i, _, y in rows] + [(i, 0) for i, _, y in rows if y] + [(i, 0) for i, _, _ in rows]
    plain = toxicity(docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int")).orderBy("doc_id").collect()
    for seed in (1, 2):
        random.Random(seed).shuffle(labels)
        given = spark.createDataFrame(labels, "doc_id bigint, toxic int").repartition(seed + 1)
        assert toxicity(docs.repartition(3), given).orderBy("doc_id").collect() == plain  # one toxic label decides


def test_finds_the_toxic_word_from_few_long_texts():
    """Of 20 toxic texts each has a few such words among hundreds of clean ones."""
    rng = random.Random(4)
    clean = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 9))) for _ in range(400)]

    def text(toxic):
        w = [rng.choice(clean) for _ in range(rng.randint(100, 400))]
        for _ in range(4 * toxic):
            w[rng.randrange(len(w))] = rng.choice(["wretchz", "wretchyz", "wrettchz"])
        return " ".join(w)

    labels = [int(i % 8 == 0) for i in range(160)]
    scorer = Scorer(train([text(y) for y in labels], labels))
    raw = [text(y).encode() for y in labels]
    got = scorer.score(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw]))
    assert np.mean((got >= 0.7) == labels) >= 0.95


def test_trains_on_texts_without_words():
    assert isinstance(train(["", " ", "bad"], [0, 0, 1]), Model)
    assert isinstance(train(["", " "], [0, 1]), Model)


def test_spans_against_plain_python():
    rng = random.Random(8)
    texts = ["", "one", " ".join(["w"] * SPAN), *(" ".join(rng.choice(["ab", "Cd", "efgh", "ij"]) for _ in range(rng.randint(1, 30))) for _ in range(40))]
    model = Model(np.random.default_rng(1).normal(size=BUCKETS), 0.3)
    raw = [t.encode() for t in texts]
    got = Scorer(model).score(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw]))

    def value(word):
        b = word.lower().encode()
        grams, _ = word_buckets(np.frombuffer(b, np.uint8), np.array([0]), np.array([len(b)]))
        return model.weight[grams].mean()

    for t, s in zip(texts, got, strict=True):
        v = [value(w) for w in t.split()]
        spans = [v[i : i + SPAN] for i in range(max(1, len(v) - SPAN + 1))]
        top = max(sum(x) / max(1, len(x)) for x in spans)
        assert abs(s - 1 / (1 + np.exp(-top - model.bias))) < 1e-9
