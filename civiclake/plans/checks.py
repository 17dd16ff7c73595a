"""The data contract's rules, measured on the star."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclake import rules
from civiclake.operators.quality import fk_violations, judge, measure, null_violations, percent, pk_violations, with_reasons


def quality_report(requests: DataFrame, location: DataFrame,
                   official: list[str] = rules.OFFICIAL_BOROUGHS) -> DataFrame:
    """Row count, completeness, validity and consistency against their limits. One pass over each table."""
    facts = measure(requests, {
        "row_count": F.count(F.lit(1)),
        "completeness_agency_key": percent(F.col("agency_key").isNotNull()),
        "completeness_location_key": percent(F.col("location_key").isNotNull()),
        "completeness_date_key": percent(F.col("date_key").isNotNull()),
        "validity_resolution_hours": percent(F.col("resolution_hours") >= 0),
    })
    places = measure(location, {"consistency_borough": percent(F.col("borough").isin(official))})
    return judge(facts.unionAll(places), rules.QUALITY_LIMITS)


def contract_report(tables: dict[str, DataFrame], official: list[str] = rules.OFFICIAL_BOROUGHS) -> DataFrame:
    """All rules of the contract: the quality report, and required columns, keys and references as rules without exception."""
    counts = [
        missing_values(tables).select(F.concat_ws(".", F.lit("required"), "table_name", "column_name"), "violations"),
        repeated_keys(tables).select(F.concat_ws(".", F.lit("unique"), "table_name"), "violations"),
        broken_references(tables).select(F.concat_ws(".", F.lit("reference"), F.lit("requests"), "column_name"), "violations"),
    ]
    counted = reduce(DataFrame.unionAll, counts).toDF("metric", "violations").select(
        "metric", F.col("violations").cast("double").alias("value"), F.lit("=").alias("comparison"),
        F.lit(0.0).alias("threshold"), F.lit("error").alias("severity"), (F.col("violations") == 0).alias("passed"),
    )
    return quality_report(tables["requests"], tables["location"], official).unionAll(counted)


def missing_values(tables: dict[str, DataFrame]) -> DataFrame:
    """NULLs in required columns, by table and column."""
    parts = [null_violations(tables[name], name, columns) for name, columns in rules.REQUIRED_COLUMNS.items()]
    return reduce(DataFrame.unionAll, parts)


def repeated_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """How many key values occur more than once, by table."""
    parts = [
        pk_violations(tables[name], keys).agg(F.count(F.lit(1)).alias("violations"))
        .select(F.lit(name).alias("table_name"), "violations")
        for name, keys in rules.PRIMARY_KEYS.items()
    ]
    return reduce(DataFrame.unionAll, parts)


def broken_references(tables: dict[str, DataFrame]) -> DataFrame:
    """Facts whose key has no dimension row, by key column."""
    return fk_violations(tables["requests"], {key: (tables[dim], key) for key, dim in rules.FOREIGN_KEYS.items()})


def judged_requests(tables: dict[str, DataFrame]) -> DataFrame:
    """The facts with what each breaks of the contract; ``quality.split_rows`` parts them."""
    references = {key: (tables[dim], key) for key, dim in rules.FOREIGN_KEYS.items()}
    return with_reasons(
        tables["requests"], rules.REQUIRED_COLUMNS["requests"], rules.PRIMARY_KEYS["requests"], references,
        {"validity_resolution_hours": F.col("resolution_hours") >= 0},
    )
