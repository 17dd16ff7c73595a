"""The registered queries as DuckDB SQL, written from the semantics, one dimension and one fact as CTEs each.

Spark sorts NULLs first, so every ordering here says so. Rounding of quotients is done on whole numbers.
"""

from __future__ import annotations

from civiclake.rules import RAW_COLUMNS, STATUS_ROWS
from fixture.raw import RAW_SQL, TEST_BOROUGH, TEST_BOROUGHS

_TIME = "'%m/%d/%Y %I:%M:%S %p'"


def _title(text: str) -> str:
    words = f"string_split(lower(trim({text})), ' ')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || w[2:]), ' ')"


def _half_up(top: str, bottom: str, scale: int) -> str:
    """top / bottom, both whole and not negative, rounded half up to 1/scale."""
    return f"(((({top}) * {2 * scale} + ({bottom})) // (2 * ({bottom}))) / {scale}.0)::double"


_CALENDAR = """strftime({0}, '%Y%m%d')::integer as date_key, {0}::date as full_date, year({0})::integer as year,
 month({0})::integer as month, quarter({0})::integer as quarter, dayname({0}) as day_of_week,
 dayofweek({0}) in (0, 6) as is_weekend,
 case when month({0}) in (12, 1, 2) then 'Winter' when month({0}) in (3, 4, 5) then 'Spring'
 when month({0}) in (6, 7, 8) then 'Summer' else 'Fall' end as season"""
_SEGMENT = """case when {0} in ('AUTOMOBILE', 'MACHINERY') then 'Industry'
 when {0} in ('HOUSEHOLD', 'FURNITURE') then 'Home' else 'Other' end"""
_CATEGORY = """case when regexp_matches({0}, '(?i)ring|rod') then 'Round' when regexp_matches({0}, '(?i)old') then 'Old'
 when regexp_matches({0}, '(?i)gear|bolt') then 'Fasten' else 'Other' end"""

_WHOLE_KEY = r"try_cast(regexp_replace(unique_key, '^(\s*[+-]?[0-9]+)\.[0-9]*(\s*)$', '\1\2') as bigint)"

_CLEAN_COLUMNS = f"""{_WHOLE_KEY} as request_id,
 try_strptime(created_date, {_TIME}) as created_date, try_strptime(closed_date, {_TIME}) as closed_date,
 upper(trim(agency)) as agency_code, {_title('agency_name')} as agency_name, {_title('problem')} as complaint_type,
 {_title('problem_detail')} as descriptor, upper(trim(borough)) as borough, {_title('city')} as city,
 nullif(trim(incident_zip), '') as incident_zip, {_title('incident_address')} as incident_address,
 upper(trim(status)) as status, upper(trim(open_data_channel_type)) as channel,
 nullif(try_cast(latitude as double), 0) as latitude, nullif(try_cast(longitude as double), 0) as longitude"""
_SILVER = [
    "request_id", "created_date", "closed_date", "agency_code", "agency_name", "complaint_type", "descriptor",
    "borough", "city", "incident_zip", "incident_address", "status", "channel", "latitude", "longitude",
]
_FIRST = [f"try_strptime({name}, {_TIME})" for name in ("created_date", "closed_date")] + [
    "agency", "agency_name", "problem", "problem_detail", "borough", "city", "incident_zip", "incident_address",
    "status", "open_data_channel_type", "latitude", "longitude",
]


def _nulls_first(names: list[str]) -> str:
    return ", ".join(f"{name} nulls first" for name in names)


_STATUS_VALUES = ", ".join(
    f"({key}, '{code}', '{label}', {str(done).lower()}, {str(waiting).lower()})"
    for key, code, label, done, waiting in STATUS_ROWS
)

_TABLES = {
    "raw": RAW_SQL,
    "clean": f"""select * from (select unique_key, {_CLEAN_COLUMNS} from raw
 where unique_key is not null and created_date is not null) where closed_date is null or closed_date > created_date""",
    "silver": f"""select {', '.join(_SILVER)} from (select {_CLEAN_COLUMNS}, row_number() over (partition by unique_key
 order by {_nulls_first(_FIRST)}) as place from raw where unique_key is not null and created_date is not null
 and (closed_date is null or coalesce(try_strptime(closed_date, {_TIME}) > try_strptime(created_date, {_TIME}),
 try_strptime(closed_date, {_TIME}) is null))) where place = 1""",
    "dates": f"select distinct {_CALENDAR.format('created_date')} from silver where created_date is not null",
    "agency": f"""select row_number() over (order by {_nulls_first(['agency_code', 'agency_name'])}) as agency_key, *,
 {_SEGMENT.format('agency_code')} as agency_type from (select distinct agency_code, agency_name from silver)""",
    # the rule default is the library's own, not the test default
    "location": f"""select row_number() over (order by {_nulls_first(['borough', 'incident_zip', 'city'])})
 as location_key, * from (select borough, incident_zip, city, avg(latitude) as latitude, avg(longitude) as longitude
 from silver where borough is not null and borough <> 'UNSPECIFIED' group by all)""",
    "complaint": f"""select row_number() over (order by complaint_type nulls first) as complaint_key, *,
 {_CATEGORY.format('complaint_type')} as category from (select distinct complaint_type from silver)""",
    "status": f"""select status_key::integer as status_key, status_code, status_label, is_resolved, is_pending
 from (values {_STATUS_VALUES}) as t(status_key, status_code, status_label, is_resolved, is_pending)""",
    "requests": """select s.request_id, strftime(s.created_date, '%Y%m%d')::integer as date_key, a.agency_key,
 l.location_key, c.complaint_key, t.status_key,
 round((epoch(s.closed_date) - epoch(s.created_date)) / 3600.0)::integer as resolution_hours
 from silver s left join agency a on s.agency_code = a.agency_code
  and s.agency_name is not distinct from a.agency_name
 left join location l on s.borough = l.borough and s.incident_zip is not distinct from l.incident_zip
  and s.city is not distinct from l.city
 left join complaint c on s.complaint_type = c.complaint_type left join status t on s.status = t.status_code""",
    "by_year": f"""select category, complaint_type, year, count(*) as request_count,
 {_half_up('sum(h)::bigint', 'count(h)', 10)} as avg_resolution_hours
 from (select *, case when resolution_hours > 0 then resolution_hours end as h from requests)
 join complaint using (complaint_key) join dates using (date_key) group by category, complaint_type, year""",
    "by_borough": f"""select borough, channel, request_count,
 {_half_up('request_count * 100', 'total', 10)} as pct_of_borough_total
 from (select *, (sum(request_count) over (partition by borough))::bigint as total
 from (select borough, channel, count(*) as request_count from requests join silver using (request_id)
 join (select location_key, borough from location) as places using (location_key, borough)
 where channel is not null group by borough, channel))""",
}
_TABLES["agency"] = _TABLES["agency"].replace("else 'Other' end", "else 'Other City Agency' end")


def _with(query: str, *, upto: str) -> str:
    """The query after the CTEs up to the named one."""
    names = list(_TABLES)
    needed = names[: names.index(upto) + 1]
    return f"with {', '.join(f'{name} as ({_TABLES[name]})' for name in needed)} {query}"


def _sent(sql: str) -> str:
    """The same over what is published as messages: all raw rows but those with a blank key."""
    return sql.replace(f"raw as ({RAW_SQL})", f"raw as (select * from ({RAW_SQL}) where trim(unique_key) <> '')")


_EVENT_TEXT = """cast(event_id as varchar) as event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as ts,
 cast(user_id as varchar) as user_id, event_type, cast(cast(floor(value * 1000) as bigint) as varchar) as value, props"""
_TYPE_COUNTS = """select borough, complaint_type, count(*) as total from requests join complaint using (complaint_key)
 join location using (location_key) group by borough, complaint_type"""


def _branches() -> str:
    branches = {
        "key_blank": "trim(unique_key) = ''",
        "key_no_number": "regexp_matches(unique_key, '[A-Z]')",
        "key_decimal_tail": "regexp_matches(unique_key, '^ *[0-9]+[.][0-9]* *$')",
        "created_unreadable": f"created_date is not null and try_strptime(created_date, {_TIME}) is null",
        "created_unreadable_while_open":
            f"try_strptime(created_date, {_TIME}) is null and try_strptime(closed_date, {_TIME}) is null",
        "closed_unreadable": f"closed_date is not null and try_strptime(closed_date, {_TIME}) is null",
        "closed_not_later": f"try_strptime(closed_date, {_TIME}) <= try_strptime(created_date, {_TIME})",
        "agency_name_missing": "agency_name is null",
        "zip_blank": "trim(incident_zip) = ''",
        "zip_literal_none": "incident_zip = 'N/A'",
        "city_missing": "city is null and borough is not null",
        "borough_missing": "borough is null",
        "status_unknown": "status = 'In Limbo'",
        "latitude_unreadable": "latitude = 'n/a'",
        "latitude_zero": "latitude = '0'",
        "longitude_with_decimals": "longitude like '%.25'",
    }
    return " union all ".join(
        f"select '{name}' as branch, count(*) as row_count from raw where {condition}" for name, condition in branches.items()
    )


def _percent(condition: str) -> str:
    return f"avg(({condition})::integer::double) * 100"


def _quality() -> str:
    official = ", ".join(f"'{name}'" for name in TEST_BOROUGHS)
    return f"""select metric, value, comparison, threshold::double as threshold, severity,
 coalesce(case when comparison = '>' then value > threshold else value = threshold end, true) as passed from (
 select 'row_count' as metric, count(*)::double as value, '>' as comparison, 0 as threshold, 'error' as severity
  from requests
 union all select 'completeness_agency_key', {_percent('agency_key is not null')}, '>', 98, 'error' from requests
 union all select 'completeness_location_key', {_percent('location_key is not null')}, '>', 90, 'warning' from requests
 union all select 'completeness_date_key', {_percent('date_key is not null')}, '>', 95, 'warning' from requests
 union all select 'validity_resolution_hours', {_percent('resolution_hours >= 0')}, '=', 100, 'error' from requests
 union all select 'consistency_borough', {_percent(f'borough in ({official})')}, '=', 100, 'error' from location)"""


_CONTRACT = {"requests": "requests", "date": "dates", "agency": "agency", "location": "location",
             "complaint": "complaint", "status": "status"}


def _nulls() -> str:
    from civiclake.rules import REQUIRED_COLUMNS

    return " union all ".join(
        f"select '{table}' as table_name, '{column}' as column_name,"
        f" count(*) filter (where {column} is null) as violations from {_CONTRACT[table]}"
        for table, columns in REQUIRED_COLUMNS.items() for column in columns
    )


def _repeated() -> str:
    from civiclake.rules import PRIMARY_KEYS

    return " union all ".join(
        f"select '{table}' as table_name, count(*) as violations from"
        f" (select {keys[0]} from {_CONTRACT[table]} group by {keys[0]} having count(*) > 1)"
        for table, keys in PRIMARY_KEYS.items()
    )


def _references() -> str:
    from civiclake.rules import FOREIGN_KEYS

    return " union all ".join(
        f"select '{key}' as column_name, count(*) as violations from requests"
        f" where {key} is not null and {key} not in (select {key} from {_CONTRACT[dim]})"
        for key, dim in FOREIGN_KEYS.items()
    )


def _contract_report() -> str:
    counted = " union all ".join((
        f"select 'required.' || table_name || '.' || column_name as metric, violations from ({_nulls()})",
        f"select 'unique.' || table_name, violations from ({_repeated()})",
        f"select 'reference.requests.' || column_name, violations from ({_references()})",
    ))
    return f"""select * from ({_quality()}) union all select metric, violations::double, '=', 0.0::double, 'error',
 violations = 0 from ({counted})"""


def _counts() -> str:
    names = {"request_raw": "raw", "request_cleaned": "silver", **_CONTRACT,
             "aggregation_complaint_by_year": "by_year", "aggregation_channel_by_borough": "by_borough"}
    return " union all ".join(
        f"select '{table}' as table_name, count(*) as row_count from {name}" for table, name in names.items()
    )


def all_oracles() -> dict[str, str]:
    raw_columns = ", ".join(RAW_COLUMNS)
    share = _half_up("line_count * 100", "total", 10)
    area_share = _half_up("request_count * 100", "total", 10)
    return {
        "csv_round_trip": "select cast(doc_id as varchar) as doc_id, nullif(text, '') as text, lang, source,"
                          " cast(n_chars as varchar) as n_chars from documents",
        "bronze_from_csv": _with(f"select {raw_columns} from raw", upto="raw"),
        "json_encode_decode": _sent(_with(f"select {raw_columns} from raw", upto="raw")),
        "infer_message_fields": f"select {_EVENT_TEXT} from events",
        "csv_multiline_split": "select cast(doc_id as varchar) as doc_id, nullif(text, '') as text, lang, source,"
                               " cast(n_chars as varchar) as n_chars from documents",
        "first_orders": "select * from orders order by o_orderdate, o_orderkey limit 100",
        "decode_by_header": f"select {_EVENT_TEXT} from events",
        # rows without a key are there from the start, so none is added
        "insert_absent": "select case when c_acctbal >= 0 then c_custkey end as c_custkey, * exclude (c_custkey)"
                         " from customer where c_acctbal >= 0 or c_mktsegment = 'BUILDING'",
        "contract_report": _with(_contract_report(), upto="requests"),
        "ingest_available_twice": f"select {_EVENT_TEXT} from events",
        "branch_counts": _with(_branches(), upto="raw"),
        "streaming_clean": _sent(_with("select * from clean", upto="clean")),
        "clean_projection": _with(f"select {_CLEAN_COLUMNS} from raw", upto="raw"),
        "valid_interval_filter": _with("select * from clean", upto="clean"),
        "keep_first_per_key": "select * exclude (place) from (select *, row_number() over (partition by l_orderkey"
                              " order by l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice) as place"
                              " from lineitem) where place = 1",
        "silver_rows": _with("select * from silver", upto="silver"),
        "events_calendar": f"select distinct {_CALENDAR.format('ts')} from events",
        "date_parts": f"select o_orderkey, {_CALENDAR.format('o_orderdate')} from orders",
        "code_label_dim": f"select row_number() over (order by c_mktsegment) as segment_key, c_mktsegment,"
                          f" {_SEGMENT.format('c_mktsegment')} as segment_type"
                          f" from (select distinct c_mktsegment from customer)",
        "category_dim": f"select row_number() over (order by p_name) as name_key, p_name,"
                        f" {_CATEGORY.format('p_name')} as category from (select distinct p_name from part)",
        "surrogate_key_scaled": "select row_number() over (order by l_orderkey, l_partkey, l_suppkey) as line_key, *"
                                " from (select distinct l_orderkey, l_partkey, l_suppkey from lineitem)",
        "date_dim": _with("select * from dates", upto="dates"),
        "agency_dim": _with("select * from agency", upto="agency"),
        "location_dim": _with("select * from location", upto="location"),
        "complaint_dim": _with("select * from complaint", upto="complaint"),
        "status_lookup": _with(
            "select s.status, s.request_count, t.status_key, t.status_label, t.is_resolved, t.is_pending from"
            " (select status, count(*) as request_count from silver group by status) s"
            " left join status t on s.status = t.status_code", upto="status"),
        "lookup_left_join": _with(
            "select request_id, complaint_type, complaint_key from silver left join complaint using (complaint_type)",
            upto="complaint"),
        "lookup_nullsafe_join": _with(_PLACES, upto="location"),
        "lookup_salted_join": _with(_PLACES, upto="location"),
        "lookup_renamed_key": _with(
            "select request_id, s.status, status_key from silver s left join status t on s.status = t.status_code",
            upto="status"),
        "hours_to_ship": "select o_orderkey, l_linenumber, l_partkey, l_suppkey,"
                         " round((epoch(l_shipdate) - epoch(o_orderdate)) / 3600.0)::integer as hours"
                         " from orders left join lineitem on o_orderkey = l_orderkey",
        "fact": _with("select * from requests", upto="requests"),
        "join_back_channel": _with(
            "select r.request_id, r.location_key, s.channel from requests r join silver s using (request_id)",
            upto="requests"),
        "rollup_by_year": _with("select * from by_year", upto="by_year"),
        "rollup_large_dims": _with("select * from by_year", upto="by_year"),
        "channel_share_large_dims": _with("select * from by_borough", upto="by_borough"),
        "ctas_rollup": _with("select category, complaint_type, year, request_count from by_year", upto="by_year"),
        "ddl_then_insert": _with("select * from dates", upto="dates"),
        "append_empty_refused": _with(f"select {raw_columns} from raw", upto="raw"),
        "channel_share": _with("select * from by_borough", upto="by_borough"),
        "channel_share_from_silver": _with("select * from by_borough", upto="by_borough"),
        "lines_share_of_mode": f"select l_suppkey, l_returnflag, line_count, {share} as pct_of_supplier from"
                               " (select *, (sum(line_count) over (partition by l_suppkey))::bigint as total from"
                               " (select l_suppkey, l_returnflag, count(*) as line_count from lineitem group by all))",
        "slowest_owners": _with(
            f"select agency_code, agency_name, count(*) as total_requests,"
            f" {_half_up('sum(resolution_hours)::bigint', 'count(*)', 1)} as avg_hours"
            f" from requests join agency using (agency_key) where resolution_hours is not null"
            f" group by agency_code, agency_name order by avg_hours desc, agency_code, agency_name limit 10",
            upto="requests"),
        "count_by_area_year": _with(
            "select borough, year, count(*) as request_count from requests join location using (location_key)"
            " join dates using (date_key) group by borough, year", upto="requests"),
        "top_types_in_area": _with(
            f"select complaint_type, total from ({_TYPE_COUNTS}) where borough = '{TEST_BOROUGH}'"
            f" order by total desc, complaint_type limit 10", upto="requests"),
        "top_types_per_area": _with(
            f"select borough, complaint_type, total, place::integer as place from (select *, row_number() over"
            f" (partition by borough order by total desc, complaint_type) as place from ({_TYPE_COUNTS}))"
            f" where place <= 10", upto="requests"),
        "sql_over_views": _with(
            f"select borough, category, request_count, {area_share} as pct_of_borough_total, avg_resolution_hours"
            f" from (select borough, category, count(*) as request_count,"
            f" (sum(count(*)) over (partition by borough))::bigint as total,"
            f" {_half_up('sum(h)::bigint', 'count(h)', 10)} as avg_resolution_hours from (select *,"
            f" case when resolution_hours > 0 then resolution_hours end as h from requests)"
            f" join complaint using (complaint_key) join location using (location_key) group by borough, category)",
            upto="requests"),
        "quality_report": _with(_quality(), upto="requests"),
        "null_violations": _with(_nulls(), upto="requests"),
        "repeated_keys": _with(_repeated(), upto="requests"),
        "broken_references": _with(_references(), upto="requests"),
        "raw_key_violations": _with(
            "select unique_key, count(*) as row_count from raw group by unique_key having count(*) > 1", upto="raw"),
        "orders_without_creditor": "select o_custkey, count(*) as row_count from orders where o_custkey not in"
                                   " (select c_custkey from customer where c_acctbal > 0) group by o_custkey",
        "fk_violation_counts": "select 'l_partkey' as column_name, count(*) as violations from lineitem"
                               " where l_partkey not in (select p_partkey from part where p_size > 10)"
                               " union all select 'l_suppkey', count(*) from lineitem"
                               " where l_suppkey not in (select s_suppkey from supplier where s_acctbal > 0)",
        "full_build_counts": _with(_counts(), upto="by_borough"),
        "silver_incremental": _sent(_with("select * from silver", upto="silver")),
        "rollup_incremental": _sent(_with("select * from by_year", upto="by_year")),
        "channel_incremental": _sent(_with("select * from by_borough", upto="by_borough")),
        "surrogate_key_continued": """with pairs as (select l_partkey, l_suppkey, bool_or(l_returnflag = 'A') as early
 from lineitem group by all) select row_number() over (order by not early, l_partkey, l_suppkey) as line_key, l_partkey,
 l_suppkey from pairs""",
        "build_switch": _switch(),
        "infer_message_types": """select event_id, floor(value * 1000) / 2 as half, event_type = 'click' as is_click, user_id,
 event_type as kind, case when event_type = 'click' then floor(value * 1000)::bigint::varchar else event_type end as mixed from events""",
        "channel_share_bucketed": _with("select * from by_borough", upto="by_borough"),
        "contract_rejects": """with judged as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, concat_ws(',',
 case when l_partkey not in (select p_partkey from part where p_size > 10) then 'reference.l_partkey' end,
 case when l_suppkey not in (select s_suppkey from supplier where s_acctbal > 0) then 'reference.l_suppkey' end,
 case when l_shipdate is null then 'required.l_shipdate' end, case when l_quantity >= 45 then 'small_quantity' end,
 case when count(*) over (partition by l_orderkey, l_linenumber) > 1 then 'unique.l_orderkey+l_linenumber' end) as reasons
 from lineitem) select * from judged where reasons <> ''""",
        "declared_write": "select * from customer",
    }


def _switch() -> str:
    """Rows per table at four moments: closed requests for all but the third, which has all."""
    names = {
        "request_cleaned": "silver", "date": "dates", "agency": "agency", "location": "location", "complaint": "complaint",
        "status": "status", "requests": "requests", "aggregation_complaint_by_year": "by_year",
        "aggregation_channel_by_borough": "by_borough",
    }
    counts = " union all ".join(f"select '{name}' as table_name, count(*) as row_count from {source}" for name, source in names.items())
    whole = _with(counts, upto="by_borough")
    closed = whole.replace(f"raw as ({RAW_SQL})", f"raw as (select * from ({RAW_SQL}) where status = 'Closed')")
    return " union all ".join(
        f"select '{moment}' as moment, table_name, row_count from ({sql})"
        for moment, sql in (("closed", closed), ("stopped", closed), ("all", whole), ("pinned", closed))
    )


_PLACES = """select request_id, s.borough, s.incident_zip, s.city, location_key from silver s left join location l
 on s.borough = l.borough and s.incident_zip is not distinct from l.incident_zip
 and s.city is not distinct from l.city"""
