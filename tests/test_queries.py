"""Every registered query against its SQL, over whole tables."""

import os

import pytest

import __spark_entry__ as driver
from checks.compare import database, difference
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    with database(SF_DIR) as connection:
        yield connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    assert difference(spark, con, SF_DIR, name) is None


def test_entry_runs(spark):
    assert driver.entry(spark).count() > 0
