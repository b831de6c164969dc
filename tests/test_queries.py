"""Every registered query against its SQL, on whole tables."""

import os

import pytest

import __spark_entry__ as entry
from compare import connect, difference
from gridcast.plans.oracle import oracle_sql
from gridcast.plans.registry import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, SQL[name]) is None


@pytest.mark.parametrize("name", ["fc_gbt_a", "fc_gbt_b", "fc_sequence_all"])
def test_trees_cover_the_test_slots(spark, name):
    """Boosted trees and long sequences have no SQL form: they must predict every test slot."""
    rows = QUERIES[name](spark, SF).collect()
    assert len(rows) == 288 * len({r.zone for r in rows})
    assert all(r.pred is not None for r in rows)


def test_tree_search_settles_every_zone(spark):
    rows = QUERIES["param_search_trees"](spark, SF).collect()
    assert len(rows) == len({r.zone for r in rows}) > 0 and all(0 < r.best_cv_mape < 1e6 and 4 <= r.n_fits < 12 for r in rows)


def test_queries_without_sql():
    assert set(QUERIES) - set(SQL) == {"fc_gbt_a", "fc_gbt_b", "fc_sequence_all", "param_search_trees"}


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert {r.zone for r in rows} > {"ALL"}
