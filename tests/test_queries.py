"""Every registered query with SQL gives DuckDB's result, also when files are laid out differently."""

import duckdb
import pytest

import __spark_entry__ as contract
from check_queries import TABLES, rows

SF = "/root/testdata/sf0.001"
WITH_SQL = sorted(contract.oracle_sql())


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in TABLES.split():
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", WITH_SQL)
def test_matches_sql(spark, con, name):
    df = contract.queries()[name](spark, SF)
    want = con.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(columns, want.fetchall())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["risk_level", "clients", "churned", "spend", "avg_orders"]
    assert sum(r["clients"] for r in df.collect()) == 150


def test_sql_only_for_registered_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())
