"""The subpackage's queries against their SQL on small tables."""

import duckdb
import pytest

from plumbline.llm.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        c.execute(f"create view {t} as select * from read_parquet('{DATA}/{t}.parquet')")
    df = QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    found = c.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == cols
    want = sorted(tuple(str(r[names.index(x)]) for x in cols) for r in found.fetchall())
    assert sorted(tuple(str(r[x]) for x in cols) for r in df.collect()) == want


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")) == list(range(1, 14))
