"""Every query with a SQL counterpart, on the same tables."""

import pytest

import oracle_check
from tallyloom.llm.queries import QUERIES
from tallyloom.llm.sql import ORACLE


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, small, name):
    assert oracle_check.differences(QUERIES[name](spark, small), oracle_check.connect(small), ORACLE[name]) == []


def test_one_query_per_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
