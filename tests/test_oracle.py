"""Every registered query against its DuckDB oracle on the smallest tables
(row count, column names, order-insensitive value digest)."""

import duckdb
import pytest

import __spark_entry__ as E
import oracle_queries
from panelkit import queries as panel_queries
from paths import SMALL
from check_oracle import TABLES, digest

QUERIES = panel_queries.QUERIES
ORACLE = oracle_queries.ORACLE


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SMALL}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["cat", "var", "Program", "Comparison", "Non-RCT", "Total"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    srows = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        assert len(srows) > 0
        return
    res = con.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(df.columns, srows)[0] == digest(ocols, orows)[0]
