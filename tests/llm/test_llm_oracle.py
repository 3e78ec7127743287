"""Queries that SQL can express against their DuckDB counterparts."""

import pytest
from conftest import SF_SMALL
from oracle_compare import compare

from tripwise.llm.queries import ORACLE_SQL, QUERIES


def test_one_query_for_each_operator():
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, duck, name):
    found = compare(QUERIES[name](spark, SF_SMALL), duck, ORACLE_SQL[name])
    assert found["match"], found
