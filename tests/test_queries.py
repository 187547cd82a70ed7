"""Every registered query against its SQL in DuckDB."""

import duckdb
import pytest

import __spark_entry__ as contract
from check_queries import TABLES, rows_of
from conftest import DATA


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{DATA}/{table}.parquet')")
    return con


@pytest.mark.parametrize("name", contract.queries())
def test_query(spark, duck, name):
    df = contract.queries()[name](spark, DATA)
    got = rows_of(df.columns, df.collect())
    if name not in contract.oracle_sql():
        assert got
        return
    result = duck.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == rows_of(columns, result.fetchall())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.dtypes == [("o_orderkey", "bigint"), ("c_name", "string"), ("n_name", "string"),
                         ("o_totalprice", "decimal(18,2)")]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
