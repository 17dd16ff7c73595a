"""Dense numbering 1..n in sort order, without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civiclake.functions.labels import all_true
from civiclake.session import scratch_path

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number within it below


def surrogate_key(df: DataFrame, name: str, order: list[str]) -> DataFrame:
    """Add ``name`` = row number over the whole table by ``order`` (ascending, NULLs first).

    ``order`` must be a total order of the rows. A window without a partition would put the table into one task.
    Here a global sort spreads the rows over range partitions and each row gets its partition and place. The table is
    written once, so both later passes see the same places whatever is re-run. Then the rows of each partition are
    counted, and the running totals (one row per partition, so safe to broadcast) turn places into numbers.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()).write.parquet(path)
    placed = spark.read.parquet(path)
    part = F.shiftright("_place", _ROW_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    row = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .select((F.col("_start") + row + 1).alias(name), *df.columns)
    )


def continued_key(known: DataFrame, rows: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """``known`` with every combination of ``columns`` in ``rows`` that it lacks (NULL counts as a value), numbered on.

    Numbers already given stay, whatever ``rows`` holds now; new combinations follow the largest one, dense and in sort order
    among themselves. Without known numbers this is ``surrogate_key`` of the combinations. Other columns of ``known`` stay, and
    are NULL in new rows. One number comes to the driver.
    """
    held = known.select(*[F.col(column).alias(f"_held_{column}") for column in columns])
    same = all_true([F.col(column).eqNullSafe(F.col(f"_held_{column}")) for column in columns])
    new = rows.select(*columns).distinct().join(held, same, "left_anti")
    last = known.agg(F.max(name).alias("last")).first()["last"] or 0
    numbered = surrogate_key(new, name, columns).withColumn(name, F.col(name) + last)
    return known.unionByName(numbered, allowMissingColumns=True)
