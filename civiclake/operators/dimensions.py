"""Dimension tables out of a detail table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from civiclake.functions.dates import calendar_parts
from civiclake.operators.numbering import surrogate_key


def calendar_dim(df: DataFrame, moment: str) -> DataFrame:
    """One row per day that occurs. Only the day is shuffled; the other parts are worked out afterwards."""
    days = df.select(F.to_date(F.col(moment)).alias("day")).where(F.col("day").isNotNull()).distinct()
    return days.select(*[part.alias(name) for name, part in calendar_parts(F.col("day")).items()])


def distinct_dim(df: DataFrame, key: str, columns: list[str], derived: dict[str, Column]) -> DataFrame:
    """One numbered row per distinct combination (NULL counts as a value), with columns derived from it."""
    combinations = df.select(*columns).distinct()
    numbered = surrogate_key(combinations, key, columns)
    return numbered.select(key, *columns, *[expression.alias(name) for name, expression in derived.items()])


def centroid_dim(df: DataFrame, key: str, columns: list[str], measures: list[str]) -> DataFrame:
    """One numbered row per combination with the mean of each measure; unknown measures are left out of the mean."""
    groups = df.groupBy(*columns).agg(*[F.avg(name).alias(name) for name in measures])
    return surrogate_key(groups, key, columns).select(key, *columns, *measures)


def literal_dim(spark: SparkSession, rows: list[tuple], schema: StructType) -> DataFrame:
    """A fixed lookup table with declared types, as literals in the plan."""
    structs = [
        F.struct(*[F.lit(value).cast(field.dataType).alias(field.name) for value, field in zip(row, schema.fields)])
        for row in rows
    ]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*structs)))
