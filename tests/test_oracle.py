"""Every named query gives the same rows in Spark and DuckDB."""

import pytest

import __spark_entry__ as entry
from oracle.compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


OWN = [name for module in entry._MODULES for name in module.QUERIES]


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", OWN)
def test_query(spark, con, name):
    assert compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], SF) == ""
