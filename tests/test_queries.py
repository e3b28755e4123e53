"""Every registered query against its SQL twin on the smallest tables."""

import pytest
from compare import compare
from conftest import SMALL

import __spark_entry__ as entry
from newsflow.plans.catalog import QUERIES
from newsflow.plans.oracle import ORACLE


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    problem = compare(entry.queries()[name](spark, SMALL), duck, entry.oracle_sql()[name])
    assert problem is None, problem


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 4
