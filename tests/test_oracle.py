"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as driver
from oracle_compare import connect, differences
from snapstats.plans.catalogue import QUERIES
from snapstats.plans.oracle import ORACLE_SQL


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query(name, spark, sf_dir, con):
    assert differences(driver.queries()[name](spark, sf_dir), con, driver.oracle_sql()[name]) is None


def test_entry(spark):
    assert not driver.entry(spark).isEmpty()
