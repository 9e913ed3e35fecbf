"""The registered queries: names, SQL, and that the rest does without this subpackage."""

import re
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E
from jobloom.llm.queries import ORACLE, REGISTRY
from tests.conftest import SF_SMOKE
from tools.oracle_check import TABLES, rows_of


def test_one_query_per_operator_and_the_pipeline():
    names = list(E.queries())
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in REGISTRY) == list(range(1, 14))
    assert set(REGISTRY) | {"pipeline"} <= set(names) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMOKE}/{t}.parquet')")
    df = REGISTRY[name](spark, SF_SMOKE)
    rel = con.execute(ORACLE[name])
    columns = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, rel.fetchall())


def test_the_rest_works_without_it():
    code = ("import sys; sys.modules['jobloom.llm'] = None; import __spark_entry__ as E; "
            "names = set(E.queries()) | set(E.oracle_sql()); assert names and not any(n.startswith('op') or n == 'pipeline' for n in names)")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=E._HERE)
