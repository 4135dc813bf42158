"""Every registered query against its SQL twin on the given tables."""

import os

import pytest

import __spark_entry__ as contract
from cohortgraph.catalogue import QUERIES
from tests.comparing import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def database():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, database, name):
    result = contract.queries()[name](spark, SF_DIR)
    assert differences(result, database, contract.oracle_sql()[name]) == []


def test_entry(spark):
    assert contract.entry(spark).columns == ["user_id", "country_short", "n_users"]
