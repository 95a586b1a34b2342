"""Every registered query with SQL is held against DuckDB on the given tables."""

import duckdb
import pytest

from readlake.plans import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if v != v else v
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    if isinstance(v, dict):
        return sorted((k, plain(x)) for k, x in v.items())
    return v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    rel = con.sql(ORACLES[name])
    cols = sorted(rel.columns)
    assert sorted(df.columns) == cols
    got = sorted(repr([plain(r.asDict(True)[c]) for c in cols]) for r in df.collect())
    want = sorted(repr([plain(dict(zip(rel.columns, r))[c]) for c in cols]) for r in rel.fetchall())
    assert got == want
