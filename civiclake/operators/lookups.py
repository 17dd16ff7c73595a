"""Joins between a large table and its lookup tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructField, StructType

from civiclake.functions.labels import all_true

BROADCAST_BYTES = 64 << 20
HOT_SHARE = 1000  # a value is hot if it holds more than 1/1000 of the rows, so fewer than 1000 values can be


_NESTED = (ArrayType, MapType, StructType)


def _octets(field: StructField) -> Column:
    if isinstance(field.dataType, _NESTED):
        return 2 * F.octet_length(F.to_json(F.struct(field.name)))
    return F.octet_length(F.col(field.name))


def data_bytes(df: DataFrame) -> int:
    """Size of the rows in memory: eight bytes per column, and the text; nested values count as twice their JSON text.

    One aggregation, one number to the driver.
    """
    fixed = F.lit(8 * (len(df.columns) + 1))
    texts = [
        F.coalesce(_octets(field), F.lit(0))
        for field in df.schema.fields if isinstance(field.dataType, (StringType, BinaryType, *_NESTED))
    ]
    total = df.select(F.sum(sum(texts, fixed).cast("bigint")).alias("bytes")).first()["bytes"]
    return total or 0


def fits_broadcast(df: DataFrame) -> bool:
    return data_bytes(df) <= BROADCAST_BYTES


def lookup_key(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    on: dict[str, str],
    null_safe: list[str] = (),
    spread: list[str] | None = None,
    count_in: DataFrame | None = None,
    shuffle: bool = False,
) -> DataFrame:
    """Add the dimension's ``key`` to every row of ``fact``; NULL where nothing matches.

    ``on`` maps fact columns to the dimension's columns and must cover the dimension's whole grain, so the row count
    stays. Columns in ``null_safe`` match NULL with NULL; in the others NULL matches nothing. A dimension measured to
    be small is broadcast; for a larger one (or with ``shuffle``) see ``_shuffled``. There ``spread`` are columns that
    differ between rows (default: all), and ``count_in`` is a table with the same key values, where that is cheaper to
    read than ``fact``.
    """
    small = dim.select(F.col(key), *[F.col(theirs).alias(f"_dim_{ours}") for ours, theirs in on.items()])
    if not shuffle and fits_broadcast(small):
        match = [_equal(fact[ours], F.col(f"_dim_{ours}"), ours in null_safe) for ours in on]
        joined = fact.join(F.broadcast(small), all_true(match), "left")
        return joined.select(*[fact[name] for name in fact.columns], F.col(key))
    hot = _hot_values(count_in or fact, list(on))
    return _shuffled(fact, small, key, list(on), null_safe, spread or fact.columns, hot)


def _hot_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """The values that hold a large share of the rows, NULL included, and to how many tasks each is dealt out: as many as its
    share of all tasks. Fewer than ``HOT_SHARE`` rows by definition."""
    rows = df.count()
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_rows"))
    salts = F.ceil(F.col("_rows") * tasks / max(rows, 1)).cast("int") + 1
    return counts.where(F.col("_rows") * HOT_SHARE > rows).select(
        *[F.col(name).alias(f"_hot_{name}") for name in columns], salts.alias("_salts")
    )


def _shuffled(fact: DataFrame, small: DataFrame, key: str, on: list[str], null_safe: list[str], spread: list[str],
              hot: DataFrame) -> DataFrame:
    """The lookup as a shuffle join. Rows with a hot value are dealt out to ``_salts`` tasks, each with its own copy of
    that dimension row; all other dimension rows move once. The salt is a hash of the row, so a re-run task deals alike.
    """
    is_hot = [F.col(name).eqNullSafe(F.col(f"_hot_{name}")) for name in on]
    dealt = F.coalesce(F.pmod(F.xxhash64(*spread), F.col("_salts")), F.lit(0))
    rows = fact.join(F.broadcast(hot), all_true(is_hot), "left").select(
        *[F.col(name).alias(f"_key_{name}") for name in on], dealt.cast("int").alias("_salt"), *fact.columns
    )
    is_hot = [F.col(f"_dim_{name}").eqNullSafe(F.col(f"_hot_{name}")) for name in on]
    copies = F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)
    dims = small.join(F.broadcast(hot), all_true(is_hot), "left").select(
        *small.columns, F.explode(copies).alias("_dim_salt")
    )
    match = [_equal(F.col(f"_key_{name}"), F.col(f"_dim_{name}"), name in null_safe) for name in on]
    match.append(F.col("_salt") == F.col("_dim_salt"))
    return rows.join(dims.hint("merge"), all_true(match), "left").select(*fact.columns, key)


def _equal(left: Column, right: Column, null_safe: bool) -> Column:
    return left.eqNullSafe(right) if null_safe else left == right


def join_back(fact: DataFrame, source: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Recover columns of the source table by its key; rows without a partner go.

    The key identifies a source row. Should it repeat all the same, the first row by ``columns`` is taken, so fact rows
    never multiply. That pass needs no shuffle of its own: the join uses the same partitioning and order.
    """
    first = F.min(F.struct(*columns)).alias("_row")
    unique = source.where(F.col(key).isNotNull()).groupBy(key).agg(first)
    return fact.join(unique, key).select(*fact.columns, *[F.col(f"_row.{name}").alias(name) for name in columns])


def unmatched(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Key values of the fact that the dimension lacks, with their row counts.

    Rows are counted per key value first, so the join moves one row per value whatever its share of the table.
    """
    values = fact.where(F.col(fact_key).isNotNull()).groupBy(fact_key).agg(F.count(F.lit(1)).alias("row_count"))
    known = dim.select(F.col(dim_key).alias("_known"))
    return values.join(known, F.col(fact_key) == F.col("_known"), "left_anti")
