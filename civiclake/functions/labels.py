"""Rule tables as expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def label_of(value: Column, groups: dict[str, list], default: str) -> Column:
    """The label whose list holds the value, else the default (also for NULL)."""
    pairs = [part for label, members in groups.items() for member in members for part in (F.lit(member), F.lit(label))]
    return F.coalesce(F.create_map(*pairs)[value], F.lit(default))


def first_match(value: Column, rules: list[tuple[str, str]], default: str) -> Column:
    """The label of the first regular expression that is found in the value, else the default (also for NULL)."""
    hits = [F.when(value.rlike(pattern), F.lit(label)) for pattern, label in rules]
    return F.coalesce(*hits, F.lit(default))


def all_true(conditions: list[Column]) -> Column:
    return reduce(lambda left, right: left & right, conditions)
