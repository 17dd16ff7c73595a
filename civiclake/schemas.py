"""One schema per table. Wall-clock times are TIMESTAMP_NTZ, so a stored value never moves with a session's time zone."""

from __future__ import annotations

from pyspark.sql import types as T

from civiclake.rules import RAW_COLUMNS

_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "time": T.TimestampNTZType(),
}


def text_schema(names: list[str]) -> T.StructType:
    """All-text, nullable."""
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def _table(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns.items()])


MESSAGE = _table(key="string", value="string")
BRONZE = text_schema(RAW_COLUMNS)
SILVER = _table(
    request_id="bigint", created_date="time", closed_date="time", agency_code="string", agency_name="string",
    complaint_type="string", descriptor="string", borough="string", city="string", incident_zip="string",
    incident_address="string", status="string", channel="string", latitude="double", longitude="double",
)
#: The raw texts and times of the first row of each key, from which silver is made; kept to compare later rows with.
FIRST = _table(
    unique_key="string", agency="string", agency_name="string", problem="string", problem_detail="string", borough="string",
    city="string", incident_zip="string", incident_address="string", status="string", open_data_channel_type="string",
    latitude="string", longitude="string", created_date="time", closed_date="time", _invalid="boolean",
)
#: What a batch adds to (or, below zero, takes from) the counts behind the two roll-ups.
YEAR_CHANGES = _table(
    complaint_type="string", year="int", row_count="bigint", measure_count="bigint", measure_sum="bigint"
)
CHANNEL_CHANGES = _table(borough="string", channel="string", row_count="bigint")
DATE = _table(
    date_key="int", full_date="date", year="int", month="int", quarter="int", day_of_week="string",
    is_weekend="boolean", season="string",
)
AGENCY = _table(agency_key="bigint", agency_code="string", agency_name="string", agency_type="string")
LOCATION = _table(
    location_key="bigint", borough="string", incident_zip="string", city="string", latitude="double",
    longitude="double",
)
COMPLAINT = _table(complaint_key="bigint", complaint_type="string", category="string")
STATUS = _table(
    status_key="int", status_code="string", status_label="string", is_resolved="boolean", is_pending="boolean"
)
REQUESTS = _table(
    request_id="bigint", date_key="int", agency_key="bigint", location_key="bigint", complaint_key="bigint",
    status_key="int", resolution_hours="int",
)
COMPLAINT_BY_YEAR = _table(
    category="string", complaint_type="string", year="int", request_count="bigint", avg_resolution_hours="double"
)
CHANNEL_BY_BOROUGH = _table(borough="string", channel="string", request_count="bigint", pct_of_borough_total="double")

TABLES = {
    "request_raw": BRONZE,
    "request_raw_stream": BRONZE,
    "request_first": FIRST,
    "request_cleaned": SILVER,
    "changes_by_year": YEAR_CHANGES,
    "changes_by_channel": CHANNEL_CHANGES,
    "date": DATE,
    "agency": AGENCY,
    "location": LOCATION,
    "complaint": COMPLAINT,
    "status": STATUS,
    "requests": REQUESTS,
    "aggregation_complaint_by_year": COMPLAINT_BY_YEAR,
    "aggregation_channel_by_borough": CHANNEL_BY_BOROUGH,
}
