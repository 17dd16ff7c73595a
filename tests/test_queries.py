"""Every registered query next to its SQL form, on the smallest test data."""

import pytest

import __spark_entry__ as entry
from compare import connect, difference
from conftest import plan_of
from fixture.oracles import all_oracles
from fixture.queries import all_queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(all_queries()))
def test_query(spark, duck, name):
    assert difference(entry.queries()[name](spark, FOLDER), duck, entry.oracle_sql()[name]) is None


def test_dirt_takes_every_branch(spark):
    counts = {row["branch"]: row["row_count"] for row in entry.queries()["branch_counts"](spark, FOLDER).collect()}
    assert len(counts) == 16 and min(counts.values()) > 0, counts


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["complaint_type", "total"] and 0 < result.count() <= 10


@pytest.mark.parametrize("name, broadcasts", [("rollup_large_dims", 0), ("channel_share_large_dims", 1), ("lookup_salted_join", 2)])
def test_forms_for_large_dimensions_shuffle(spark, name, broadcasts):
    """The plan that ran joins dimensions by sorting; only hot values (under 1000 rows) and totals per area are broadcast."""
    result = entry.queries()[name](spark, FOLDER)
    result.collect()
    ran = plan_of(result).split("Initial Plan")[0]
    assert "SortMergeJoin" in ran and ran.count("BroadcastHashJoin") + ran.count("BroadcastNestedLoopJoin") <= broadcasts
