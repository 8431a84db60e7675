"""Driver contract, and every registered query against its SQL oracle on
the smallest given tables (sf0.001)."""

import datetime as dt
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as ent
from strata.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="given tables not present")


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(repr(_norm(r[i])) for i in order) for r in rows))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry(spark):
    df = ent.entry(spark)
    assert df.count() > 0
    assert "session_id" in df.columns and "event_path" in df.columns


def test_every_query_has_oracle_or_is_marked():
    q, o = ent.queries(), ent.oracle_sql()
    assert set(o) <= set(q)
    assert set(QUERIES) == set(ORACLE_SQL)          # the library's own queries all have one
    assert set(QUERIES) <= set(q)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = ent.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ent.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(df.columns, rows) == _canon(ocols, orows)
