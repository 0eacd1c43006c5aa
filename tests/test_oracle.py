"""Every registered query against its SQL, over whole tables."""

import pytest
from compare import database, difference

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return database(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, con, name):
    result = difference(spark, con, name, queries()[name], SQL[name], SF)
    assert result in ("", "EMPTY on both sides"), result


def test_every_sql_has_its_query():
    assert set(SQL) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
