"""Every registered query against its SQL, or at least for rows."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
import oracle

QUERIES = driver.queries()
SQL = driver.oracle_sql()


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert driver.entry(spark).count() == 30


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    result = oracle.spark_rows(QUERIES[name](spark, sf_dir))
    if name in SQL:
        assert oracle.difference(result, oracle.duck_rows(duck, SQL[name])) is None
    else:
        assert result[1]
