"""Every registered query against its DuckDB oracle on the smallest test tables,
as the round driver checks at sf0.01 (python tools/oracle_check.py runs that)."""

import duckdb
import pytest

import __spark_entry__ as E
import oracle_sql
from jobloom.plans import queries as Q
from tests.conftest import SF_SMOKE
from tools.oracle_check import TABLES, rows_of

QUERIES = dict(Q.REGISTRY)
SQL = oracle_sql.oracle()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMOKE}/{t}.parquet')")
    return c


def test_every_oracle_has_a_query():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMOKE)
    rows = [tuple(r) for r in df.collect()]
    rel = con.execute(SQL[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(dcols)
    assert rows_of(df.columns, rows) == rows_of(dcols, rel.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["batch_no", "Index", "Position title", "complexity_score", "category", "seniority_level"]
    assert df.count() > 0
