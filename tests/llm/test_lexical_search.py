import math
import random
import re
from collections import Counter

import pytest

from plumbline.llm import lexical_search
from plumbline.llm.lexical_search import BlockMaxIndex

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def split(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, queries, k):
    docs = [(i, Counter(split(t))) for i, t in docs]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    n, total = len(docs), sum(x for _, _, x in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    terms = {}
    for item, text in queries:
        terms.setdefault(item, set()).update(split(text))
    out = []
    for item, ts in terms.items():
        rows = []
        for i, c, length in docs:
            m = 100 - 50 + (50 * length * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in ts if t in c)
            if s > 0:
                rows.append((-s, i is None, i))
        rows.sort(key=lambda r: (r[0], r[1], r[2] or 0))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(rows[:k])]
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    vocab = [f"{'Wörd' if i % 3 else 'term'}{i}" for i in range(120)]
    weights = [1 / (i + 1) for i in range(120)]
    docs = [(i * 3, rng.choice([" ", ", ", "-_"]).join(rng.choices(vocab, weights, k=rng.choice([1, 3, 20, 90])))) for i in range(500)]
    docs += [(7, docs[0][1]), (7, docs[0][1]), (None, docs[1][1]), (None, None), (10_001, ""), (10_002, "!! --"), (10_003, "term0 " * 30_000)]
    queries = [(j, " ".join(rng.choices(vocab, k=rng.choice([1, 2, 8, 30])))) for j in range(25)]
    queries += [(3, "another TERM6"), (100, None), (101, ""), (None, "term9 term9"), (102, "nowhere"), (103, " ".join(vocab))]
    return docs, queries


@pytest.mark.parametrize("block, k", [(128 << 10, 50), (300, 5), (2000, 3)])
def test_matches_brute_force(spark, monkeypatch, block, k):
    monkeypatch.setattr(lexical_search, "BLOCK", block)
    docs, queries = corpus(block)
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id bigint, text string, terms string").repartition(3)
    q = spark.createDataFrame([(i, t, 1) for i, t in queries], "item_id bigint, text string, doc_id int")
    got = BlockMaxIndex.build(df).search(q, "item_id", k)
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(docs, queries, k)


def test_groups_of_queries(spark, monkeypatch):
    docs, queries = corpus(1)
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    index = BlockMaxIndex.build(df)
    monkeypatch.setattr(lexical_search, "GROUP", 40)
    got = index.search(spark.createDataFrame(queries, "item_id bigint, text string"), "item_id", 10)
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(docs, queries, 10)


def test_blocks_below_the_threshold_are_not_scored(spark):
    q = lexical_search.Queries([lexical_search.np.array([3, 9], "uint64")])
    q.weights = lexical_search.np.array([10, 1])
    assert q.bounds(lexical_search.np.array([1, 3], "uint64"), lexical_search.np.array([7, 5])).tolist() == [50]
    assert q.bounds(lexical_search.np.array([9, 11], "uint64"), lexical_search.np.array([7, 5])).tolist() == [7]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    queries = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert BlockMaxIndex.build(docs).search(queries).count() == 0
    some = BlockMaxIndex.build(spark.createDataFrame([(1, "a b")], "doc_id bigint, text string"))
    assert some.search(queries.where("false")).count() == 0
    assert [tuple(r) for r in some.search(queries).select("item_id", "rank", "doc_id").collect()] == [(1, 1, 1)]


def test_index_is_read_in_small_row_groups(spark, tmp_path):
    """A row is a block, and a row group's rows are read at once: its bytes stay few however many blocks a task writes."""
    import pyarrow.parquet as pq

    rng = random.Random(5)
    texts = [" ".join(f"{rng.getrandbits(24):06x}" for _ in range(18_000)) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    index = BlockMaxIndex.build(docs, str(tmp_path / "index"))
    groups = [m.row_group(i) for f in (tmp_path / "index").glob("*.parquet") for m in [pq.ParquetFile(f).metadata] for i in range(m.num_row_groups)]
    assert sum(g.num_rows for g in groups) == 60
    assert max(g.total_byte_size for g in groups) < 16 << 20 < sum(g.total_byte_size for g in groups)
    item = texts[41][:70]
    assert index.search(spark.createDataFrame([(1, item)], "item_id bigint, text string")).first().doc_id == 41


def test_block_of_short_documents_holds_postings_only(spark):
    """Many short documents and many terms asked for: what is held grows with the words, not with documents times terms."""
    rng = random.Random(9)
    docs = [(i, " ".join(rng.choices([f"w{j}" for j in range(600)], k=3))) for i in range(4000)]
    index = BlockMaxIndex.build(spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(1))
    batch = index._read("*").toArrow().combine_chunks().to_batches()[0]
    q = lexical_search.Queries([lexical_search._ints(batch, "terms", 0, lexical_search.U64)])
    q.weigh(lexical_search._ints(batch, "df", 0), index.n)
    block = lexical_search.Block(batch, 0, q, index.n, index.total)
    assert batch.num_rows == 1 and len(block.ids) == 4000 and len(q.terms) == 600
    assert sum(x.nbytes for x in vars(block).values()) < 1 << 20
    ids, scores = block.scores(q.places, 1)
    assert sorted((i, s) for _, _, i, s in brute(docs, [(1, " ".join(f"w{j}" for j in range(600)))], 4000)) == sorted(zip(ids.tolist(), scores.tolist(), strict=True))
