"""Duplicate removal."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order: list[str], ties: list[str]) -> DataFrame:
    """The first row of every key group by ``order``, ascending, NULLs first.

    ``ties`` go on where ``order`` leaves rows equal and must make the choice unique, so a re-run task picks the same
    row. Spark sorts a task's rows and keeps one per key before the window's shuffle. So that no task sorts all rows that a
    file's part holds, rows are first gathered by a hash of the key, in pieces of the advisory size: a hot key is split into
    several, and each sends one row. The hash is a column of its own; by the key itself, the window would take the
    pieces for whole groups, and they could not be split.
    """
    if not ties:
        raise ValueError("name tie-break columns, or the kept row depends on task timing")
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, *ties))
    gathered = df.withColumn("_group", F.xxhash64(*keys)).hint("rebalance", "_group")
    return gathered.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank", "_group")
