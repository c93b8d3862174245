"""Every registered query against its SQL counterpart, and the driver contract."""

import pytest

import __spark_entry__ as contract
import oracle_check
from tallyloom.plans.catalog import QUERIES
from tallyloom.plans.oracle import ORACLE


@pytest.fixture(scope="module")
def duck(small):
    return oracle_check.connect(small)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, duck, small, name):
    assert oracle_check.differences(QUERIES[name](spark, small), duck, contract.oracle_sql()[name]) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 20
