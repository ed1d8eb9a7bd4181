"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract
from checks.compare import database, difference
from invoicemill import catalogue, oracles

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables to compare on")


@pytest.fixture(scope="module")
def sql():
    return database(FOLDER)


def test_every_query_has_sql():
    """All of the library's own; of the training-data operators those that SQL can express, the others have brute-force tests."""
    assert set(catalogue.QUERIES) == set(oracles.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query(spark, sql, name):
    assert difference(contract.queries()[name](spark, FOLDER), sql, contract.oracle_sql()[name]) == ""


def test_entry(spark):
    assert contract.entry(spark).columns == ["vendor_name", "total_amount"]
