"""Calendar parts and durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from civiclake.functions.labels import label_of
from civiclake.rules import DATE_KEY_TEXT, SEASON_DEFAULT, SEASONS


def date_key(moment: Column) -> Column:
    """The day as an INT such as 20150131."""
    return F.date_format(moment, DATE_KEY_TEXT).cast("int")


def is_weekend(moment: Column) -> Column:
    return F.dayofweek(moment).isin(1, 7)  # 1 is Sunday


def season(moment: Column) -> Column:
    return label_of(F.month(moment), SEASONS, SEASON_DEFAULT)


def calendar_parts(moment: Column) -> dict[str, Column]:
    """All calendar columns of a date or timestamp."""
    return {
        "date_key": date_key(moment),
        "full_date": F.to_date(moment),
        "year": F.year(moment),
        "month": F.month(moment),
        "quarter": F.quarter(moment),
        "day_of_week": F.date_format(moment, "EEEE"),
        "is_weekend": is_weekend(moment),
        "season": season(moment),
    }


def elapsed_hours(start: Column, end: Column) -> Column:
    """Whole hours, half up; NULL while the end is not known."""
    seconds = F.unix_timestamp(end) - F.unix_timestamp(start)
    return F.round(seconds / F.lit(3600.0)).cast("int")
