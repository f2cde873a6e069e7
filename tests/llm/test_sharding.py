import zlib
from collections import Counter

from plumbline.llm.sharding import interleaved, write_shards

SCHEMA = "doc_id bigint, text string, source string, shard int, h string, cell int"


def frame(spark):
    rows = [(i, f"text {i} é" * (i % 5), ["a", "b", None, "c"][min(i % 7, 3)], 7, "x", 1) for i in range(900)]
    rows += [(5, "again", "a", 0, None, None), (5, "again", "a", 0, None, None), (None, None, None, None, None, None), (901, "", "only one", 0, "", 0), (902, "x" * 200_000, "b", 0, "", 0)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3), rows


def test_law_sizes_and_slots(spark):
    df, rows = frame(spark)
    got = interleaved(df, 40).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows)
    per = Counter(r.shard for r in got)
    assert set(per) == set(range(40)) and max(per.values()) - min(per.values()) <= 1
    for s in per:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(per[s]))
    assert {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}
    again = interleaved(df.repartition(5), 40).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_every_shard_has_the_mixture(spark):
    df, rows = frame(spark)
    source = {r[0]: r[2] for r in rows}
    total = Counter(r[2] for r in rows)
    got = interleaved(df.where("doc_id is not null and doc_id <> 5"), 10).collect()
    for s in range(10):
        per = Counter(source[r.doc_id] for r in got if r.shard == s)
        for name, n in total.items():
            assert abs(per[name] - n / 10) <= 1.5


def test_cells_change_nothing(spark, monkeypatch):
    df, _ = frame(spark)
    want = sorted(map(str, interleaved(df).collect()))
    monkeypatch.setattr("plumbline.llm.sharding.CELL", 30)
    assert sorted(map(str, interleaved(df).collect())) == want


def test_few_rows_and_none(spark):
    df, _ = frame(spark)
    few = interleaved(df.where("doc_id < 3"), 40).collect()
    assert len(few) == 3 and {r.slot for r in few} == {0} and len({r.shard for r in few}) == 3
    assert interleaved(df.where("false")).count() == 0


def test_shards_are_written(spark, tmp_path):
    df, rows = frame(spark)
    path = write_shards(df, f"{tmp_path}/out", 8)
    back = spark.read.parquet(path)
    assert Counter((r.doc_id, r.text, r.source, r.h, r.cell) for r in back.collect()) == Counter((r[0], r[1], r[2], r[4], r[5]) for r in rows)
    placed = Counter((r.shard, r.slot) for r in back.collect())
    assert len(placed) == len(rows) and max(placed.values()) == 1
