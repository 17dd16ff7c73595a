"""Cleaning, validity and duplicate removal."""

import datetime as dt

import pytest
from conftest import plan_of, request, values
from pyspark.sql import functions as F

from civiclake.operators.dedupe import keep_first
from civiclake.plans.silver import clean_rows, silver
from civiclake.schemas import SILVER


def test_schema(bronze_rows):
    result = silver(bronze_rows(request("1")))
    assert result.schema == SILVER


def test_one_clean_row(bronze_rows):
    row = silver(bronze_rows(request(
        "7", closed="01/03/2015 01:00:00 PM", agency=" nypd ", problem="HEAT/HOT WATER", problem_detail="no heat",
        incident_zip=" ", incident_address="1 MAIN STREET", latitude="0", longitude="-73.5",
    ))).first()
    assert tuple(row) == (
        7, dt.datetime(2015, 1, 2, 1), dt.datetime(2015, 1, 3, 13), "NYPD", "Police", "Heat/hot Water", "No Heat",
        "QUEENS", "Rego Park", None, "1 Main Street", "OPEN", "PHONE", None, -73.5,
    )


def test_interval_rules(bronze_rows):
    rows = bronze_rows(
        request("1", created="x"),                                         # unknown start, open: kept
        request("2", created="x", closed="01/02/2015 01:00:00 AM"),        # unknown start, closed: dropped
        request("3", closed="01/02/2015 01:00:00 AM"),                     # no time between: dropped
        request("4", closed="01/02/2015 01:00:01 AM"),                     # kept
        request("5", closed="01/01/2015 01:00:00 AM"),                     # ends before: dropped
        request("6", closed="bad"),                                        # unreadable end counts as open: kept
        request(None), request("8", created=None),                         # required texts missing: dropped
        request("abc"),                                                    # key is no number: kept, without id
    )
    kept = values(silver(rows), "request_id", "created_date")
    start = dt.datetime(2015, 1, 2, 1)
    assert kept == [(None, start), (1, None), (4, start), (6, start)]


def test_earliest_valid_row_wins(bronze_rows):
    rows = bronze_rows(
        request("1", created="01/05/2015 01:00:00 AM", city="late"),
        request("1", created="01/03/2015 01:00:00 AM", city="first"),
        request("1", created="01/01/2015 01:00:00 AM", closed="01/01/2015 01:00:00 AM", city="invalid"),
        request("2", city="b"), request("2", city="a"),
    )
    assert values(silver(rows), "request_id", "city") == [(1, "First"), (2, "A")]


def test_silver_is_the_first_of_the_clean_rows(bronze_rows):
    rows = bronze_rows(*[
        request(str(i % 7), created=f"01/{1 + i % 28:02d}/2015 01:00:00 AM",
                closed=f"01/{1 + (i * 5) % 28:02d}/2015 01:00:00 AM" if i % 3 else None) for i in range(200)
    ])
    expected = {}
    for row in clean_rows(rows).collect():
        order = (row.created_date, row.closed_date is not None, row.closed_date or 0)
        expected[row.unique_key] = min(expected.get(row.unique_key, order), order)
    got = {str(r.request_id): (r.created_date, r.closed_date is not None, r.closed_date or 0)
           for r in silver(rows).collect()}
    assert got == expected


def test_hot_key_is_cut_before_the_shuffle(spark, bronze_rows):
    plan = plan_of(silver(bronze_rows(request("1"))))
    assert plan.index("row_number(), 1, Final") < plan.index("Exchange hashpartitioning(unique_key")
    assert plan.index("Exchange hashpartitioning(unique_key") < plan.index("row_number(), 1, Partial")
    assert plan.count("gettimestamp") <= 2, "each time is parsed once"


def test_only_needed_columns_are_read(spark, bronze_rows, tmp_path):
    bronze_rows(request("1")).write.parquet(str(tmp_path / "raw"))
    scan = plan_of(silver(spark.read.parquet(str(tmp_path / "raw")))).split("FileScan")[1]
    assert "IsNotNull(unique_key), IsNotNull(created_date)" in scan
    assert "landmark" not in scan and "resolution_description" not in scan


def test_keep_first_wants_ties(spark):
    with pytest.raises(ValueError):
        keep_first(spark.range(3), ["id"], ["id"], [])


def test_texts_and_times_of_all_rows_are_worked_out_once(spark, bronze_rows):
    """A filter on a computed text or a parsed time works neither out again."""
    made = F.concat(F.lit("01/02/2015 0"), F.col("unique_key"), F.lit(":00:00 AM"))
    rows = bronze_rows(request("1"), request("2", closed="01/01/2015 01:00:00 AM"), request(None)).withColumn("created_date", made)
    found = clean_rows(rows)
    spark.conf.set("spark.sql.debug.maxToStringFields", "100")
    plan = plan_of(found)
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert plan.count("gettimestamp") == 2 and plan.count("01/02/2015 0") == 1
    assert values(found, "unique_key", "request_id") == [("1", 1)]


def test_rows_are_gathered_before_they_are_sorted(spark):
    rows = spark.range(3000).selectExpr("if(id % 3 = 0, null, if(id % 3 = 1, 'hot', cast(id as string))) as key", "id % 7 as day", "id")
    first = keep_first(rows, ["key"], ["day"], ["id"])
    plan = plan_of(first)
    assert plan.count("WindowGroupLimit") == 2, "a key's rows are cut before the window's shuffle"
    assert "Exchange" in plan[plan.rindex("Sort ["):], "no task sorts all rows of its part of the input"
    found = {row["key"]: row["id"] for row in first.collect()}
    assert first.columns == ["key", "day", "id"] and len(found) == 1002 and found[None] == 0 and found["hot"] == 7 and found["5"] == 5
