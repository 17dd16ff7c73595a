"""Data-contract checks. All percentages of one table come from a single pass over it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civiclake.operators.lookups import fits_broadcast, unmatched


def percent(condition: Column) -> Column:
    """Percent of rows for which the condition holds. Rows for which it is unknown (NULL) are left out."""
    return F.avg(condition.cast("double")) * 100


def measure(df: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    """Rows (metric, value): every aggregate of ``metrics`` in one pass, then turned upright."""
    row = df.agg(*[value.cast("double").alias(name) for name, value in metrics.items()])
    pairs = [F.struct(F.lit(name).alias("metric"), F.col(name).alias("value")) for name in metrics]
    return row.select(F.inline(F.array(*pairs)))


def judge(measured: DataFrame, limits: dict[str, tuple[str, float, str]]) -> DataFrame:
    """Add each metric's limit, severity and whether it passed. A metric without a value has nothing against it."""
    metric, value = F.col("metric"), F.col("value")

    def pick(position: int) -> Column:
        return F.create_map(*[F.lit(part) for name in limits for part in (name, limits[name][position])])[metric]

    passed = F.when(pick(0) == ">", value > pick(1)).otherwise(value == pick(1))
    return measured.select(
        metric, value, pick(0).alias("comparison"), pick(1).alias("threshold"), pick(2).alias("severity"),
        F.coalesce(passed, F.lit(True)).alias("passed"),
    )


def null_violations(df: DataFrame, table: str, required: list[str]) -> DataFrame:
    """Rows (table, column, violations) for every required column, in one pass."""
    row = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in required])
    triples = [
        F.struct(
            F.lit(table).alias("table_name"), F.lit(name).alias("column_name"), F.col(name).alias("violations")
        )
        for name in required
    ]
    return row.select(F.inline(F.array(*triples)))


def pk_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their row counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)


def fk_violations(fact: DataFrame, dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows (column, violations): fact rows whose key is known but missing in its dimension.

    ``dims`` maps a fact column to the dimension and the dimension's key column.
    """
    counts = [
        unmatched(fact, dim, column, key).agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("violations"))
        .select(F.lit(column).alias("column_name"), "violations")
        for column, (dim, key) in dims.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def _marked(rows: DataFrame, broken: DataFrame, columns: list[str], mark: str) -> DataFrame:
    """Adds ``mark``, true where the columns' values are among the broken ones, NULL like any value."""
    values = broken.select(*[F.col(name).alias(f"_broken_{name}") for name in columns], F.lit(True).alias(mark))
    same = reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(f"_broken_{name}")) for name in columns])
    values = F.broadcast(values) if fits_broadcast(values) else values.hint("merge")
    return rows.join(values, same, "left").drop(*[f"_broken_{name}" for name in columns])


def with_reasons(
    rows: DataFrame, required: list[str], key: list[str], references: dict[str, tuple[DataFrame, str]],
    values: dict[str, Column],
) -> DataFrame:
    """Adds ``reasons``, what each row breaks of its contract, sorted; an empty list for a good row.

    ``required.COLUMN``: no value. ``unique.KEY``: another row has its key. ``reference.COLUMN``: its value has no row in the
    dimension. ``values`` maps names of further reasons to conditions that good rows fulfil; where one is unknown (NULL) it holds.
    Only distinct key values are compared with a dimension, and only broken ones come back to the rows: measured, and broadcast
    if they are few.
    """
    reasons = {f"required.{name}": F.col(name).isNull() for name in required}
    reasons |= {name: ~condition for name, condition in values.items()}
    out = _marked(rows, pk_violations(rows, key), key, "_repeated") if key else rows
    marks = {f"unique.{'+'.join(key)}": "_repeated"} if key else {}
    for k, (column, (dim, dim_key)) in enumerate(references.items()):
        out = _marked(out, unmatched(rows, dim, column, dim_key), [column], f"_lost_{k}")
        marks[f"reference.{column}"] = f"_lost_{k}"
    reasons |= {name: F.col(mark) for name, mark in marks.items()}
    found = F.array(*[F.when(F.coalesce(broken, F.lit(False)), name) for name, broken in sorted(reasons.items())])
    return out.select(*rows.columns, F.array_compact(found).alias("reasons"))


def split_rows(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows without reasons, as they were, and the refused ones with theirs."""
    good = F.size("reasons") == 0
    return judged.where(good).drop("reasons"), judged.where(~good)
