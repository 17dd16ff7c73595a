"""Grouped reports over a star."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civiclake.operators.clean import require
from civiclake.operators.lookups import fits_broadcast


def star_sums(
    fact: DataFrame, dims: dict[str, DataFrame], by: list[str] = (), measure: Column | None = None, shuffle: bool = False
) -> DataFrame:
    """Facts per combination of the dimensions' columns and the fact's ``by`` columns.

    ``dims`` maps a key of the fact to a dimension cut down to that key and the columns to group by. The result has
    ``row_count`` and, for a ``measure``, ``measure_count`` and ``measure_sum`` of its known values; ``mean_measure``
    turns these into a mean. Facts whose key is unknown or has no dimension row are left out.

    A dimension measured to be small is broadcast and its columns take the key's place before anything moves: each task
    then sums into few groups (a year, not a day). For a larger one the facts are summed per key first, so that its
    shuffle join moves sums, and a hot key is one row by then. Then the sums are summed. ``shuffle`` takes all dimensions
    for large.
    """
    rows, large, groups = require(fact, list(dims)), {}, list(by)
    for key, dim in dims.items():
        if not shuffle and fits_broadcast(dim):
            rows = rows.join(F.broadcast(dim), key)
            groups += [name for name in dim.columns if name != key]
        else:
            large[key] = dim
    first = {"row_count": F.count(F.lit(1))}
    if measure is not None:
        first |= {"measure_count": F.count(measure), "measure_sum": F.sum(measure)}
    sums = rows.groupBy(*groups, *large).agg(*[total.alias(name) for name, total in first.items()])
    if not large:
        return sums
    for key, dim in large.items():
        sums = sums.join(dim.hint("merge"), key)
        groups += [name for name in dim.columns if name != key]
    return sums.groupBy(*groups).agg(*[F.sum(name).alias(name) for name in first])


def mean_measure(digits: int) -> Column:
    """The rounded mean in a result of ``star_sums``; NULL for a group without known values."""
    return F.round(F.try_divide(F.col("measure_sum").cast("double"), F.col("measure_count")), digits)


def share_of_parent(counts: DataFrame, parent: str, count: str, name: str) -> DataFrame:
    """Add each row's percent of its parent's total, to one decimal.

    The totals are summed in their own aggregation and joined, so no task has to hold a parent's rows.
    """
    totals = counts.groupBy(F.col(parent).alias("_parent")).agg(F.sum(count).alias("_total"))
    share = F.round(F.lit(100.0) * F.col(count) / F.col("_total"), 1)
    joined = counts.join(totals, F.col(parent).eqNullSafe(F.col("_parent")))
    return joined.select(*counts.columns, share.alias(name))


def first_rows(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first n rows by an order that should be total. Each task keeps n rows."""
    return df.orderBy(*order).limit(n)


def top_k(df: DataFrame, measure: str, ties: list[str], k: int) -> DataFrame:
    """The k rows with the largest measure, best first. Each task keeps k rows; nothing is sorted as a whole."""
    return df.orderBy(F.desc(measure), *ties).limit(k)


def top_k_per_group(df: DataFrame, group: str, measure: str, ties: list[str], k: int) -> DataFrame:
    """The k rows with the largest measure in every group, with their ``place``.

    Spark cuts every group to k rows in each map task before the shuffle, for k up to
    ``spark.sql.optimizer.windowGroupLimitThreshold``.
    """
    place = F.row_number().over(Window.partitionBy(group).orderBy(F.desc(measure), *ties))
    return df.withColumn("place", place).where(F.col("place") <= k)
