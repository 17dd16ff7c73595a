"""Tables of a relational database, over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from civiclake.rules import DATABASE_TABLES
from civiclake.sources.tables import Store

BATCH_ROWS = 10_000


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    split_on: str | None = None,
    low: int | None = None,
    high: int | None = None,
    parts: int | None = None,
) -> DataFrame:
    """A table scan. ``split_on``, ``low``, ``high`` and ``parts`` read it in parallel ranges of a numeric column.

    Rows outside low..high are read too, by the outermost ranges. Without a split one task reads the whole table, which
    is right for lookup tables only. Filters and column choice reach the database.
    """
    split = (split_on, low, high, parts)
    if any(value is not None for value in split):
        if any(value is None for value in split):
            raise ValueError("a split read needs split_on, low, high and parts")
        return spark.read.jdbc(
            url, table, column=split_on, lowerBound=low, upperBound=high, numPartitions=parts, properties=properties
        )
    return spark.read.jdbc(url, table, properties=properties)


def read_jdbc_by_key(
    spark: SparkSession, url: str, table: str, properties: dict[str, str], column: str, parts: int
) -> DataFrame:
    """A table scan in ``parts`` ranges of a numeric column, between the bounds the database gives for it."""
    bounds = spark.read.jdbc(
        url, f"(select min({column}) as low, max({column}) as high from {table}) bounds", properties=properties
    ).first()
    low, high = bounds  # by place, since databases differ in the case of names
    if low is None or low == high:
        return read_jdbc(spark, url, table, properties)
    return read_jdbc(spark, url, table, properties, column, int(low), int(high), parts)


def write_jdbc(
    df: DataFrame, url: str, table: str, properties: dict[str, str], mode: str = "append", connections: int = 16
) -> None:
    """Append rows, or overwrite the rows and keep the table's definition.

    ``connections`` bounds how many tasks write at once. A lost task is written again, so append to a table that is read
    by key, or overwrite.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode must be append or overwrite, not {mode!r}")
    df.write.mode(mode).options(batchsize=BATCH_ROWS, truncate="true", numPartitions=connections).jdbc(
        url, table, properties=properties
    )


def export(
    store: Store, url: str, properties: dict[str, str], tables: list[str] | None = None, connections: int = 16
) -> None:
    """Replace the rows of database tables by those of the stored ones (default: all of silver and gold)."""
    for table in tables or [name for name in DATABASE_TABLES if name != "request_raw"]:
        write_jdbc(store.read(table), url, DATABASE_TABLES[table], properties, "overwrite", connections)
