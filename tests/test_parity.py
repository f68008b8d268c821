"""Every query against its SQL, all values equal."""

import pytest

import __spark_entry__ as contract
from parity import connect, differences
from tallymart.plans.catalogue import QUERIES
from tallymart.plans.comparison import COMPARISON_SQL


@pytest.fixture(scope="module")
def other(sf_dir):
    return connect(sf_dir)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == COMPARISON_SQL.keys()
    assert QUERIES.keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, sf_dir, other, name):
    assert differences(contract.queries()[name](spark, sf_dir), other, contract.oracle_sql()[name]) == []


def test_entry_has_rows(spark, sf_dir):
    assert contract.entry(spark).count() == 25
