"""Cleaning, calendar and label expressions on edge values."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from civiclake.functions import text
from civiclake.functions.dates import calendar_parts, elapsed_hours
from civiclake.functions.labels import first_match, label_of
from civiclake.rules import (
    AGENCY_TYPE_DEFAULT, AGENCY_TYPES, COMPLAINT_CATEGORIES, COMPLAINT_CATEGORY_DEFAULT, TIMESTAMP_TEXT,
)


def apply(spark, column, inputs):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [row.r for row in rows.select("i", column.alias("r")).orderBy("i").collect()]


def test_trim_takes_blanks_only(spark):
    assert apply(spark, text.upper_text("v"), ["  a b ", "\tx", None]) == ["A B", "\tX", None]


def test_title_breaks_words_at_blanks_only(spark):
    given_texts = ["HEAT/HOT WATER", " noise - street ", "o'neil", ""]
    assert apply(spark, text.title_text("v"), given_texts) == ["Heat/hot Water", "Noise - Street", "O'neil", ""]


def test_blank_becomes_null(spark):
    assert apply(spark, text.blank_to_null("v"), ["  ", "", None, " 1 "]) == [None, None, None, "1"]


def test_zero_and_bad_coordinates_become_null(spark):
    given_texts = ["0", "0.0", "-0", "", "x", None, " 40.7 ", "-73.9"]
    assert apply(spark, text.nonzero_number("v"), given_texts) == [None] * 6 + [40.7, -73.9]


def test_whole_number(spark):
    assert apply(spark, text.whole_number("v"), ["12", " 7 ", "x", "", None, "1" * 30]) == [12, 7] + [None] * 4
    assert apply(spark, text.whole_number("v"), ["123.0", "-123.9", " 4. ", "1e3", "1.2.3", "1.x"]) == [123, -123, 4] + [None] * 3


def test_clock_time(spark):
    given_texts = ["01/02/2015 12:05:09 AM", "01/02/2015 12:05:09 PM", "01/02/2015 01:05:09 PM", "1/2/2015 1:05:09 AM",
                   "02/30/2015 01:00:00 AM", "01/02/2015 13:00:00 AM", "x", "", None]
    expected = [dt.datetime(2015, 1, 2, 0, 5, 9), dt.datetime(2015, 1, 2, 12, 5, 9), dt.datetime(2015, 1, 2, 13, 5, 9)]
    assert apply(spark, text.clock_time("v", TIMESTAMP_TEXT), given_texts) == expected + [None] * 6


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.datetimes(dt.datetime(1900, 1, 1), dt.datetime(2099, 12, 31)), min_size=1, max_size=40))
def test_clock_time_reads_what_is_written(spark, moments):
    moments = [moment.replace(microsecond=0) for moment in moments]
    texts = [moment.strftime("%m/%d/%Y %I:%M:%S %p") for moment in moments]
    assert apply(spark, text.clock_time("v", TIMESTAMP_TEXT), texts) == moments


def test_is_blank(spark):
    assert apply(spark, text.is_blank("v"), [None, "", "  ", " a"]) == [True, True, True, False]


def test_calendar_parts(spark):
    days = ["2024-02-29", "2023-12-31", "2024-06-01", "2024-11-04"]
    frame = spark.createDataFrame([(d,) for d in days], "d string").select(F.to_date("d").alias("d"))
    parts = calendar_parts(F.col("d"))
    rows = frame.select(*[c.alias(n) for n, c in parts.items()]).orderBy("date_key").collect()
    got = [(r.date_key, r.year, r.month, r.quarter, r.day_of_week, r.is_weekend, r.season) for r in rows]
    assert got == [
        (20231231, 2023, 12, 4, "Sunday", True, "Winter"),
        (20240229, 2024, 2, 1, "Thursday", False, "Winter"),
        (20240601, 2024, 6, 2, "Saturday", True, "Summer"),
        (20241104, 2024, 11, 4, "Monday", False, "Fall"),
    ]


@pytest.mark.parametrize("minutes, hours", [(0, 0), (29, 0), (30, 1), (31, 1), (89, 1), (90, 2), (150, 3), (None, None)])
def test_elapsed_hours_round_half_up(spark, minutes, hours):
    start = F.lit(dt.datetime(2024, 3, 10, 1, 45)).cast("timestamp_ntz")
    end = F.lit(None).cast("timestamp_ntz") if minutes is None else start + F.make_dt_interval(mins=F.lit(minutes))
    assert spark.range(1).select(elapsed_hours(start, end).alias("h")).first().h == hours


def test_first_matching_rule_wins(spark):
    given_texts = ["Illegal Parking", "Street Condition", "Noise - Park", "Water Leak", "Paint", "Bus Stop", None]
    column = first_match(F.col("v"), COMPLAINT_CATEGORIES, COMPLAINT_CATEGORY_DEFAULT)
    assert apply(spark, column, given_texts) == [
        "Transportation", "Parks", "Noise", "Water & Sewer", "Housing Maintenance", "Other", "Other"
    ]


def test_every_agency_label(spark):
    codes = [code for members in AGENCY_TYPES.values() for code in members]
    labels = [label for label, members in AGENCY_TYPES.items() for _ in members]
    column = label_of(F.col("v"), AGENCY_TYPES, AGENCY_TYPE_DEFAULT)
    assert apply(spark, column, codes + ["XYZ", "nypd", None]) == labels + ["Other City Agency"] * 3
