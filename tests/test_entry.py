"""The driver contract, and every query against its SQL twin on the smallest data."""

import pytest

import __spark_entry__ as entry
from lakeloom.queries import all_queries, all_sql

from .compare import DATA, differences, duck

SF = f"{DATA}/sf0.001"
WIDE_RUNS = {"layer_counts"}  # minutes of small writes; run by tests/compare.py


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_a_twin():
    assert set(all_sql()) == set(all_queries())


def test_entry_lists_every_query():
    assert set(all_queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["region", "orders", "revenue"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(set(all_queries()) - WIDE_RUNS))
def test_query_matches_sql(spark, con, name):
    assert differences(all_queries()[name](spark, SF), con.sql(all_sql()[name])) is None
