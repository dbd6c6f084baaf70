"""Every query of the core against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from kiteloom.plans import catalog

DATA = os.environ.get("KITELOOM_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return repr(v)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_matches_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    r = duck.execute(catalog.SQL[name])
    there = [x[0] for x in r.description]
    assert sorted(there) == columns
    want = sorted(tuple(plain(x[there.index(c)]) for c in columns) for x in r.fetchall())
    assert sorted(tuple(plain(x[c]) for c in columns) for x in df.collect()) == want


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_runs(spark, name):
    assert catalog.QUERIES[name](spark, DATA).count() >= 0
