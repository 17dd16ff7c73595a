"""Silver: typed, cleaned rows, one per unique key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civiclake.functions.text import blank_to_null, clock_time, nonzero_number, title_text, upper_text, whole_number
from civiclake.operators.clean import is_valid_interval, project, require, valid_interval, worked_out
from civiclake.operators.dedupe import keep_first
from civiclake.rules import TIMESTAMP_TEXT
from civiclake.schemas import SILVER

KEY = "unique_key"
_TIMES = ["created_date", "closed_date"]
_USED = [
    "unique_key", "agency", "agency_name", "problem", "problem_detail", "borough", "city", "incident_zip",
    "incident_address", "status", "open_data_channel_type", "latitude", "longitude",
]
#: The raw columns that cleaned rows are made of.
RAW_USED = [*_USED, *_TIMES]


def time_spec() -> dict[str, Column]:
    return {name: clock_time(name, TIMESTAMP_TEXT) for name in _TIMES}


def text_spec() -> dict[str, Column]:
    return {
        "request_id": whole_number("unique_key"),
        "agency_code": upper_text("agency"),
        "agency_name": title_text("agency_name"),
        "complaint_type": title_text("problem"),
        "descriptor": title_text("problem_detail"),
        "borough": upper_text("borough"),
        "city": title_text("city"),
        "incident_zip": blank_to_null("incident_zip"),
        "incident_address": title_text("incident_address"),
        "status": upper_text("status"),
        "channel": upper_text("open_data_channel_type"),
        "latitude": nonzero_number("latitude"),
        "longitude": nonzero_number("longitude"),
    }


def cleaning_spec() -> dict[str, Column]:
    """All cleaned columns out of raw ones, in table order."""
    spec = {**time_spec(), **text_spec()}
    return {name: spec[name] for name in SILVER.names}


def clean_rows(bronze: DataFrame) -> DataFrame:
    """Cleaned rows with a valid interval, duplicates included, with their raw key. Runs on a stream too.

    The raw texts are worked out once, where they are no plain columns, and so are the times; the rest only of valid rows.
    """
    texts = worked_out(bronze, {name: F.col(name) for name in RAW_USED})
    timed = worked_out(require(texts, [KEY, "created_date"]), {**{name: F.col(name) for name in _USED}, **time_spec()})
    valid = valid_interval(timed, *_TIMES)
    spec = {**text_spec(), **{name: F.col(name) for name in _TIMES}}
    return project(valid, {KEY: F.col(KEY), **{name: spec[name] for name in SILVER.names}})


#: What makes a row of a key the first: valid before invalid, then the times, then the raw texts.
ORDER, TIES = ["_invalid", *_TIMES], _USED[1:]


def candidates(bronze: DataFrame) -> DataFrame:
    """Rows with a key and a date, the raw texts that silver uses, and whether they are invalid; times are parsed, once."""
    timed = project(require(bronze, [KEY, "created_date"]), {
        **{name: F.col(name) for name in _USED}, **time_spec()
    })
    return timed.withColumn("_invalid", ~is_valid_interval(*_TIMES))


def cleaned(first: DataFrame) -> DataFrame:
    """Silver rows of the first row per key; a key without a valid row goes. Further columns of ``first`` stay in front."""
    spec = {**{name: F.col(name) for name in _TIMES}, **text_spec()}
    others = [name for name in first.columns if name not in [*_USED, *_TIMES, "_invalid"]]
    chosen = {**{name: F.col(name) for name in others}, **{name: spec[name] for name in SILVER.names}}
    return project(first.where(~F.col("_invalid")), chosen)


def silver(bronze: DataFrame) -> DataFrame:
    """The earliest valid row of every unique key, cleaned. The raw texts break ties, so the result is always the same.

    Times are parsed first, once, and duplicates go before the other columns are cleaned. An invalid row sorts behind
    every valid one of its key, so it is first only where no valid row exists, and then the key is dropped: a filter in
    front would parse the times a second time.
    """
    return cleaned(keep_first(candidates(bronze), [KEY], ORDER, TIES))
