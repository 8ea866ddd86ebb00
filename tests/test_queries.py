"""Every registered query against its SQL on the smallest test tables."""

import importlib.util
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registry
from matchlore import catalog

_PATH = Path(__file__).resolve().parents[1] / "tools" / "check_queries.py"
_SPEC = importlib.util.spec_from_file_location("check_queries", _PATH)
check = importlib.util.module_from_spec(_SPEC)
_SPEC.loader.exec_module(check)


@pytest.fixture(scope="module")
def oracle(data):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for table in check.TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{data}/{table}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", list(registry.oracle_sql()))
def test_query(spark, data, oracle, name):
    df = registry.queries()[name](spark, data)
    result = oracle.execute(registry.oracle_sql()[name])
    columns = [item[0] for item in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert check.rows_of(df.columns, df.collect()) == check.rows_of(columns, result.fetchall())


def test_entry(spark, data):
    assert registry.entry(spark).columns == ["match_id", "n"]
