"""Every catalog query against its DuckDB oracle on the smallest test tables."""

import pytest

from conftest import SF_SMALL
from oracle_compare import compare

import __spark_entry__ as entry

from tripwise.plans.catalog import QUERIES

ORACLE = entry.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    res = compare(QUERIES[name](spark, SF_SMALL), duck, ORACLE[name])
    assert res["match"], res


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "offer_acceptance_rate" in df.columns
