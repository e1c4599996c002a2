"""Every registered query equals its DuckDB twin (the correctness gate, at sf0.001)."""

import pytest

from snaplake.checks.catalog import oracle_queries, spark_queries
from snaplake.checks.compare import compare

QUERIES = spark_queries()
SQL = oracle_queries()


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_parity(spark, con, sf_dir, name):
    rec = compare(spark, con, name, QUERIES[name], SQL.get(name), sf_dir)
    assert rec["ok"], rec
