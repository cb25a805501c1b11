"""Every registered query against its DuckDB twin on the smallest tables:
same columns, same row count, same order-insensitive value digest."""

import duckdb
import pytest

import __spark_entry__ as E
from tidemark.plans import catalog
from tools.compare import TABLES, digest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.SQL)
    assert set(catalog.QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["instrument_id", "trade_date"]
