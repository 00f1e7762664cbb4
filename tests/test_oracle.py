"""Every query with checking SQL gives the same rows in both engines."""

import pytest

import __spark_entry__ as entry_points
from compare import connect, difference

SQL = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_check_has_a_query():
    assert set(SQL) <= set(entry_points.queries())


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, con, sf_dir, name):
    result = entry_points.queries()[name](spark, sf_dir)
    assert difference(result, con, SQL[name]) is None
