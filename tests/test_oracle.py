"""Every registered query with a SQL twin must agree with it on the small tables."""

import pytest
from oracle_compare import compare, connect

import __spark_entry__ as entry

ORACLE = entry.oracle_sql()
# Fits many models; checked at a larger scale by tests/oracle_compare.py.
SLOW = {"univariate_f_classes"}


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(set(ORACLE) - SLOW))
def test_query_matches_sql(spark, sf, con, name):
    assert compare(entry.queries()[name](spark, sf), con, ORACLE[name]) == []


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() == 8
