"""The driver's contract: names, SQL beside queries, and results that agree on the smallest tables."""

import datetime
import decimal
import os

import pytest

import __spark_entry__ as entry
from veilstream.queries import catalogue

FOLDER = "/root/testdata/sf0.001"
there = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(catalogue.SQL) <= set(catalogue.QUERIES)


@there
def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["c_mktsegment", "n_orders", "revenue"] and df.count() > 0


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(FOLDER) if os.path.isdir(FOLDER) else ():
        c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{FOLDER}/{f}'")
    return c


def plain(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return str(v) if isinstance(v, decimal.Decimal) else v


@there
@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query_equals_sql(spark, duck, name):
    df = catalogue.QUERIES[name](spark, FOLDER)
    cur = duck.execute(catalogue.SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    want = sorted(str([plain(r[names.index(c)]) for c in order]) for r in cur.fetchall())
    assert sorted(str([plain(r[c]) for c in order]) for r in df.collect()) == want
