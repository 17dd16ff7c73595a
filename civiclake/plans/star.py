"""Gold: the dimensions around the request fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake import rules
from civiclake.functions.dates import date_key, elapsed_hours
from civiclake.functions.labels import first_match, label_of
from civiclake.operators.dimensions import calendar_dim, centroid_dim, distinct_dim, literal_dim
from civiclake.operators.lookups import lookup_key
from civiclake.schemas import REQUESTS, STATUS


def date(silver: DataFrame) -> DataFrame:
    return calendar_dim(silver, "created_date")


def agency(silver: DataFrame, types: dict[str, list] = rules.AGENCY_TYPES,
           default: str = rules.AGENCY_TYPE_DEFAULT) -> DataFrame:
    kind = label_of(F.col("agency_code"), types, default)
    return distinct_dim(silver, "agency_key", ["agency_code", "agency_name"], {"agency_type": kind})


def location(silver: DataFrame) -> DataFrame:
    known = silver.where(F.col("borough") != rules.NO_AREA)  # not true for NULL either
    return centroid_dim(known, "location_key", ["borough", "incident_zip", "city"], ["latitude", "longitude"])


def complaint(silver: DataFrame, categories: list[tuple[str, str]] = rules.COMPLAINT_CATEGORIES,
              default: str = rules.COMPLAINT_CATEGORY_DEFAULT) -> DataFrame:
    category = first_match(F.col("complaint_type"), categories, default)
    return distinct_dim(silver, "complaint_key", ["complaint_type"], {"category": category})


def status(spark: SparkSession) -> DataFrame:
    return literal_dim(spark, rules.STATUS_ROWS, STATUS)


def requests(silver: DataFrame, agency: DataFrame, location: DataFrame, complaint: DataFrame,
             status: DataFrame) -> DataFrame:
    """One row per silver row. Lookups use each dimension's whole grain, so none multiplies a request."""
    lookups = [
        (agency, "agency_key", {"agency_code": "agency_code", "agency_name": "agency_name"}, ["agency_name"]),
        (location, "location_key", {"borough": "borough", "incident_zip": "incident_zip", "city": "city"},
         ["incident_zip", "city"]),
        (complaint, "complaint_key", {"complaint_type": "complaint_type"}, []),
        (status, "status_key", {"status": "status_code"}, []),
    ]
    rows = silver
    for dim, key, on, null_safe in lookups:
        rows = lookup_key(
            rows, dim, key, on, null_safe, spread=["request_id", "created_date", "closed_date"], count_in=silver
        )
    return rows.withColumns({
        "date_key": date_key(F.col("created_date")),
        "resolution_hours": elapsed_hours(F.col("created_date"), F.col("closed_date")),
    }).select(*REQUESTS.names)
