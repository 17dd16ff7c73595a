"""Turning text columns into clean or typed values. Bad text becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def upper_text(name: str) -> Column:
    return F.upper(F.trim(F.col(name)))


def title_text(name: str) -> Column:
    """Capital first letter of every blank-separated word: ``HEAT/HOT WATER`` gives ``Heat/hot Water``."""
    return F.initcap(F.trim(F.col(name)))


def blank_to_null(name: str) -> Column:
    return F.nullif(F.trim(F.col(name)), F.lit(""))


def whole_number(name: str) -> Column:
    """A bigint; a decimal tail of digits is cut off, so ``123.9`` gives 123."""
    return F.regexp_replace(F.col(name), r"^(\s*[+-]?[0-9]+)\.[0-9]*(\s*)$", "$1$2").try_cast("bigint")


def nonzero_number(name: str) -> Column:
    """A double; zero stands for "not known" in coordinate columns and becomes NULL."""
    return F.nullif(F.col(name).try_cast("double"), F.lit(0.0))


def clock_time(name: str, pattern: str) -> Column:
    """Wall-clock time without a zone. The session zone must be UTC, which has no skipped hours."""
    return F.try_to_timestamp(F.col(name), F.lit(pattern)).cast("timestamp_ntz")


def is_blank(name: str) -> Column:
    """True for NULL as well as for blanks."""
    return F.coalesce(F.trim(F.col(name)), F.lit("")) == ""
