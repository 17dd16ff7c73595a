"""Row filters and the many-column cleaning projection. Stateless, so they run on batch and streaming input alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civiclake.functions.labels import all_true


def require(df: DataFrame, names: list[str]) -> DataFrame:
    """Rows in which every named column has a value. On a table scan the filter reaches the files."""
    return df.where(all_true([F.col(name).isNotNull() for name in names]))


def is_valid_interval(start: str, end: str) -> Column:
    """True while the interval is open or if it ends after it starts, else false, never NULL.

    An unknown start is valid only while the end is unknown too; equal times are not valid.
    """
    return F.coalesce(F.col(end).isNull() | (F.col(end) > F.col(start)), F.lit(False))


def valid_interval(df: DataFrame, start: str, end: str) -> DataFrame:
    return df.where(is_valid_interval(start, end))


def project(df: DataFrame, spec: dict[str, Column]) -> DataFrame:
    """One projection from a ``{name: expression}`` table; unnamed columns go, so scans read only what is used."""
    return df.select(*[expression.alias(name) for name, expression in spec.items()])


def worked_out(df: DataFrame, spec: dict[str, Column]) -> DataFrame:
    """``project``, but each expression is worked out once per row, whatever is done with its result.

    Spark moves filters below a projection and writes a column's expression in wherever the column is named, so a costly one is
    worked out again for each use. It moves nothing below a generator, and this one gives a single row.
    """
    row = F.struct(*[expression.alias(name) for name, expression in spec.items()])
    return df.select(F.explode(F.array(row)).alias("_row")).select(*[F.col("_row").getField(name).alias(name) for name in spec])
