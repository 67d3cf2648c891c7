"""Every registered query against its SQL on the smallest test tables."""

import pytest
from compare import compare, duck

from __spark_entry__ import entry, oracle_sql, queries
from registry import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert compare(spark, con, queries()[name], oracle_sql()[name], sf_dir) is None


def test_queries_and_sql_belong_together():
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).count() > 0
