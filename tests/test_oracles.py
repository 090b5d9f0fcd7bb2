"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.check_oracles import TABLES, compare

DATA = "/root/testdata/sf0.001"
QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", [n for n in QUERIES if n in SQL])
def test_query(spark, tables, name):
    outcome = compare(spark, tables, name, QUERIES[name], SQL.get(name), DATA)
    assert outcome.startswith("ok"), outcome


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry(spark).count() > 0
