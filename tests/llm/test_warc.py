import hashlib
import random

import pytest

from plumbline.llm import warc


def test_round_trip(spark, tmp_path):
    rng = random.Random(1)
    base = ["x" * 99, "y" * 100, "é" * 50, "z" * 300_000, "", None, "ü" * 70_001, "q\r\n\r\nHTTP/1.1 200 OK\r\n\r\n" * 20]
    rows = [(i, rng.choice(["http://a/?q=1", None, "http://b/ x\r\ny"]), rng.choice(base), "h") for i in range(200)]
    rows += [(None, "http://n", "y" * 100, "h")] + [(300, "http://n", "ab" * 90_000, "h")] * 3 + [(300, "http://n", "z" * 300_000, "h")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, payload_digest string").repartition(4)
    got = sorted([tuple(r) for r in warc.warc_round_trip(df, str(tmp_path / "w")).collect()], key=str)
    first, want = {}, []
    for i, _, h, _ in rows:
        b = (h or "").encode()
        if len(b) >= 100 and i is not None:
            first[b] = min(i, first.get(b, i))
    for i, _, h, _ in rows:
        b = (h or "").encode()
        again = len(b) >= 100 and i is not None and first[b] != i
        want.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first[b] if again else None))
    assert got == sorted(want, key=str)
    table = spark.read.parquet(str(tmp_path / "w"))
    assert table.where(f"length(data) > {warc.CHUNK} + 1000").count() == 0
    assert table.where("chunk_no > 0").count() > 0
    one = table.where("chunk_no > 0").first().record_id
    data = b"".join(r.data for r in table.where(table.record_id == one).orderBy("chunk_no").collect())
    fields, at = warc._head(data)
    body = data[at:-4]
    assert fields["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(body).hexdigest()
    assert int(fields["Content-Length"]) == len(data) - data.index(b"\r\n\r\n") - 4 - 4


def test_damage_is_found_and_empty_table(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "a" * 200_000)], "page_id bigint, url string, html string")
    rows = warc.chunk_records(df).collect()
    cut = spark.createDataFrame([r for r in rows if r.chunk_no != 1], "segment bigint, record_id string, chunk_no int, last boolean, data binary, sha256 string")
    with pytest.raises(Exception, match="missing|damaged"):
        warc.read_archive(cut).collect()
    schema = "segment bigint, record_id string, chunk_no int, last boolean, data binary, sha256 string"
    three = spark.createDataFrame([(1, "u", "a" * 200_000), (2, "u", "b" * 150_000), (3, "u", "c" * 10)], "page_id bigint, url string, html string").repartition(1)
    rows = warc.chunk_records(three).collect()
    for gone in (lambda r: r.last and r.chunk_no > 0, lambda r: r.last and r.segment % 2 == 0, lambda r: r.chunk_no == 0 and not r.last):
        lost = spark.createDataFrame([r for r in rows if not gone(r)], schema)
        with pytest.raises(Exception, match="is missing"):
            warc.read_archive(lost).collect()
    assert len({r.record_id for r in rows}) == 3
    assert warc.warc_round_trip(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0
