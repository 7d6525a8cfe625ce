"""The driver contract: entry() runs, every query has a matching oracle
(value-compared with DuckDB on the smallest tables)."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracles import TABLES, rows_of
from weblens.plans import registry

from conftest import SF_SMALL

ROWS_ONLY: set[str] = set()


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "rowkey" in df.columns and "browsername" in df.columns


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) - set(entry.oracle_sql()) == ROWS_ONLY
    assert set(registry.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - ROWS_ONLY))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    s, scols = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(entry.oracle_sql()[name])
    o, ocols = rows_of([c[0] for c in res.description], res.fetchall())
    assert scols == ocols
    assert Counter(s) == Counter(o)
