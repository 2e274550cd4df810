"""Every query with SQL agrees with it, row for row."""

from __future__ import annotations

import pytest
from compare import connect, differences

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, folder, name):
    assert differences(spark, con, folder, name, QUERIES[name], SQL[name]) is None


def test_entry_has_rows_and_schema(spark):
    df = entry.entry(spark)
    assert "anomaly_percentage" in df.columns
    assert df.limit(1).count() == 1


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
