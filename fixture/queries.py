"""The registered queries. Each reads whole tables and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.functions.dates import calendar_parts, elapsed_hours
from civiclake.functions.labels import first_match, label_of
from civiclake.functions.text import is_blank
from civiclake.operators.clean import project
from civiclake.operators.dedupe import keep_first
from civiclake.operators.dimensions import calendar_dim, distinct_dim
from civiclake.operators.lookups import join_back, lookup_key, unmatched
from civiclake.operators.numbering import continued_key, surrogate_key
from civiclake.operators.quality import fk_violations, pk_violations, split_rows, with_reasons
from civiclake.operators.rollups import first_rows, share_of_parent
from civiclake.plans import bronze, checks, incremental, reports, run, silver, star
from civiclake.plans.views import register_views
from civiclake.rules import RAW_COLUMNS, STATUS_ROWS
from civiclake.schemas import DATE, MESSAGE
from civiclake.session import pin_settings, scratch_path
from civiclake.sources.csv import read_csv_text, write_csv_text
from civiclake.sources.messages import decode_inferred, decode_messages, decode_typed, encode_messages, matched_fields
from civiclake.sources.tables import COMPACT, Store, buckets_for, create_tables, save_as_table, save_bucketed, scratch_database, slices
from civiclake.streaming.ingest import append_available, stream_message_files
from fixture.raw import (
    TEST_AGENCY_DEFAULT, TEST_AGENCY_TYPES, TEST_BOROUGH, TEST_BOROUGHS, TEST_CATEGORIES, TEST_CATEGORY_DEFAULT, raw,
    table,
)

_stores: dict[tuple[str, str], Store] = {}
RULES = {"agency_types": TEST_AGENCY_TYPES, "categories": TEST_CATEGORIES}


def stored(spark: SparkSession, sf_dir: str) -> Store:
    """Bronze, silver and gold of the test tables, written once per session, as the reports expect them."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stores:
        store = Store(spark, scratch_path(spark, "store"))
        rows = store.write(raw(spark, sf_dir), "request_raw", by="unique_key")
        run.build(store, rows, **RULES)
        _stores[key] = store.pinned()
    return _stores[key]


# --- sources ---------------------------------------------------------------------------------------------------------

def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "documents-csv")
    write_csv_text(documents, path)
    return read_csv_text(spark, path, documents.columns)


def csv_multiline_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in CSV files read in parts of 64 KiB, so that many records span two parts."""
    documents = table(spark, sf_dir, "documents")
    root = scratch_path(spark, "documents-split")
    write_csv_text(documents, f"{root}/csv")
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, str(64 << 10))
    try:  # worked out here, while the setting holds
        read_csv_text(spark, f"{root}/csv", documents.columns).write.parquet(f"{root}/rows")
    finally:
        spark.conf.set(name, before)
    return spark.read.parquet(f"{root}/rows")


def first_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first hundred orders by date and key."""
    return first_rows(table(spark, sf_dir, "orders"), ["o_orderdate", "o_orderkey"], 100)


def bronze_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "raw-csv")
    for rows in slices(raw(spark, sf_dir), "unique_key"):
        write_csv_text(rows, path, "append", compressed=True)
    return bronze.load(spark, "csv", path=path)


def _raw_messages(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "messages")
    for rows in slices(raw(spark, sf_dir), "unique_key"):
        encode_messages(rows, "unique_key").write.mode("append").options(**COMPACT).parquet(path)
    return path


def json_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = spark.read.schema(MESSAGE).parquet(_raw_messages(spark, sf_dir))
    return bronze.load(spark, "messages", messages=messages)


def _event_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of ``events`` as text; the value in whole thousandths, which every engine writes alike."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
        F.col("user_id").cast("string"), "event_type", F.floor(F.col("value") * 1000).cast("string").alias("value"), "props",
    )


def infer_message_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_inferred(encode_messages(_event_texts(spark, sf_dir), "event_id"))


def infer_message_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers, truth values, an object, and a field that is a number in some messages and a text in others."""
    thousandths = F.floor(F.col("value") * 1000)
    kind = F.col("event_type")
    fields = F.struct(
        "event_id", (thousandths / 2).alias("half"), (kind == "click").alias("is_click"),
        F.struct("user_id", kind.alias("kind")).alias("user"),
    )
    mixed = F.when(kind == "click", thousandths.cast("string")).otherwise(F.concat(F.lit('"'), kind, F.lit('"')))
    body = F.concat(F.regexp_replace(F.to_json(fields), "\\}$", ""), F.lit(',"mixed":'), mixed, F.lit("}"))
    found = decode_typed(table(spark, sf_dir, "events").select(body.alias("value")))
    return found.select("event_id", "half", "is_click", "user.user_id", "user.kind", "mixed")


def decode_by_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages whose fields are named like a file's header, matched to columns by name or by a given table."""
    events = _event_texts(spark, sf_dir)
    fields = {"event_id": "Event ID", "ts": "Time Stamp", "user_id": "USER-id", "event_type": "event type",
              "value": "Value", "props": "Props"}
    messages = encode_messages(events, "event_id", fields)
    return decode_messages(messages, events.columns, matched_fields(messages, events.columns, {"ts": "Time Stamp"}))


def insert_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One segment's customers, then all, twice; those with a debt have no key, and are told apart by nothing but that."""
    key = F.when(F.col("c_acctbal") >= 0, F.col("c_custkey"))
    customer = table(spark, sf_dir, "customer").withColumn("c_custkey", key)
    store = Store(spark, scratch_path(spark, "insert"))
    store.write(customer.where(F.col("c_mktsegment") == "BUILDING"), "customer")
    store.insert_absent(customer, "customer", ["c_custkey"])
    return store.insert_absent(customer, "customer", ["c_custkey"])


# --- streaming -------------------------------------------------------------------------------------------------------

def ingest_available_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries and three runs: each message arrives once."""
    events = _event_texts(spark, sf_dir)
    root = scratch_path(spark, "ingest")
    early = F.col("event_type") == "click"
    for delivery in (early, ~early):
        encode_messages(events.where(delivery), "event_id").write.mode("append").parquet(f"{root}/in")
        _ingest(spark, root, events.columns)
    _ingest(spark, root, events.columns)
    return spark.read.parquet(f"{root}/out")


def _ingest(spark: SparkSession, root: str, columns: list[str]) -> None:
    stream = decode_messages(stream_message_files(spark, f"{root}/in"), columns)
    append_available(stream, f"{root}/out", f"{root}/checkpoint")


def streaming_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = stream_message_files(spark, _raw_messages(spark, sf_dir))
    cleaned = silver.clean_rows(decode_messages(messages, RAW_COLUMNS))
    root = scratch_path(spark, "streaming-clean")
    append_available(cleaned, f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out")


# --- silver ----------------------------------------------------------------------------------------------------------

def clean_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(raw(spark, sf_dir), silver.cleaning_spec())


def valid_interval_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.clean_rows(raw(spark, sf_dir))


def keep_first_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    ties = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return keep_first(lineitem, ["l_orderkey"], ["l_shipdate"], ties)


def branch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many raw rows take each branch of the cleaning that plain data never takes, in one pass."""
    spec = {f"_{name}": column for name, column in silver.cleaning_spec().items()}
    known = [row[1] for row in STATUS_ROWS]

    def lost(name: str, cleaned: str) -> Column:
        return F.col(name).isNotNull() & F.col(cleaned).isNull()

    branches = {
        "key_blank": is_blank("unique_key"),
        "key_no_number": ~is_blank("unique_key") & F.col("_request_id").isNull(),
        "key_decimal_tail": F.col("unique_key").contains(".") & F.col("_request_id").isNotNull(),
        "created_unreadable": lost("created_date", "_created_date"),
        "created_unreadable_while_open": lost("created_date", "_created_date") & F.col("_closed_date").isNull(),
        "closed_unreadable": lost("closed_date", "_closed_date"),
        "closed_not_later": F.col("_closed_date") <= F.col("_created_date"),
        "agency_name_missing": F.col("_agency_code").isNotNull() & F.col("_agency_name").isNull(),
        "zip_blank": lost("incident_zip", "_incident_zip"),
        "zip_literal_none": F.col("_incident_zip") == "N/A",
        "city_missing": F.col("_borough").isNotNull() & F.col("_city").isNull(),
        "borough_missing": F.col("_borough").isNull(),
        "status_unknown": ~F.col("_status").isin(known),
        "latitude_unreadable": lost("latitude", "_latitude") & (F.col("latitude") != "0"),
        "latitude_zero": F.col("latitude") == "0",
        "longitude_with_decimals": F.col("_longitude") != F.floor("_longitude"),
    }
    rows = raw(spark, sf_dir).withColumns(spec)
    counts = rows.agg(*[F.count_if(condition).alias(name) for name, condition in branches.items()])
    return counts.unpivot([], list(branches), "branch", "row_count")


def silver_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver(raw(spark, sf_dir))


# --- new rows alone --------------------------------------------------------------------------------------------------

def _by_kind(rows: DataFrame) -> list[DataFrame]:
    """Three parts by kind of product, so that a later part holds earlier rows of keys in a former one."""
    kind = F.coalesce(F.col("problem_detail"), F.lit(""))
    return [rows.where(kind >= "S"), rows.where((kind >= "M") & (kind < "S")), rows.where(kind < "M")]


def _deliveries(spark: SparkSession, sf_dir: str, name: str | None = None) -> list[DataFrame]:
    """All raw rows in three deliveries. The rows are worked out once and written, as the table ``name``, and each part is read from
    there."""
    name = name or f"deliveries_{uuid.uuid4().hex}"
    for rows in slices(raw(spark, sf_dir), "unique_key"):
        save_as_table(rows, name, "append")
    return _by_kind(spark.table(name))


_merged: dict[tuple[str, str], Store] = {}


def merged(spark: SparkSession, sf_dir: str) -> Store:
    """A store that has taken over three deliveries of messages as a stream, the second of them, by its name, once more."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _merged:
        store = Store(spark, scratch_path(spark, "merged"))
        with scratch_database(spark) as scratch:
            deliveries = _deliveries(spark, sf_dir, f"{scratch}.deliveries")
            for sent, rows in enumerate(deliveries, 1):
                encode_messages(rows, "unique_key").write.mode("append").options(**COMPACT).parquet(store.path("messages"))
                if sent == len(deliveries):  # all are messages by now
                    spark.sql(f"DROP TABLE {scratch}.deliveries")
                incremental.follow(stream_message_files(spark, store.path("messages"), taken="delete"), store, width=5000)
        version = store.tables()
        again = _by_kind(raw(spark, sf_dir))[1]
        if incremental.merge(store, again, "messages-1", width=5000) or store.tables() != version:
            raise AssertionError("a batch was taken over twice")
        _merged[key] = store.pinned()
    return _merged[key]


def silver_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver after three deliveries, each merged with the kept first rows of the buckets it touches."""
    return merged(spark, sf_dir).read("request_cleaned")


def rollup_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first roll-up out of the three batches' sums; what a later row replaced is taken off."""
    return incremental.complaint_by_year(merged(spark, sf_dir), TEST_CATEGORIES, TEST_CATEGORY_DEFAULT)


def channel_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.channel_by_borough(merged(spark, sf_dir))


def surrogate_key_continued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts and suppliers of lines that went by air, numbered; then those of all lines, which keep these numbers."""
    columns = ["l_partkey", "l_suppkey"]
    lineitem = table(spark, sf_dir, "lineitem")
    first = surrogate_key(lineitem.where(F.col("l_returnflag") == "A").select(*columns).distinct(), "line_key", columns)
    return continued_key(first, lineitem, "line_key", columns)


def build_switch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per table as readers see them: after a build of closed requests, after one of all requests that dies half-way, and
    after one that ends; and what a reader that pinned the first build sees at the end."""
    store = Store(spark, scratch_path(spark, "switch"))
    rows = store.write(raw(spark, sf_dir), "request_raw", by="unique_key")  # worked out once for the three builds
    run.build(store, rows.where(F.col("status") == "Closed"), **RULES)
    reader = store.pinned()
    seen = [("closed", reader)]
    try:  # the pattern of a category is no pattern, so the run ends between its tables
        run.build(store, rows, agency_types=TEST_AGENCY_TYPES, categories=[("(", "Broken")])
    except (PySparkException, Py4JJavaError):
        seen.append(("stopped", store.pinned()))
    run.build(store, rows, **RULES)
    seen += [("all", store.pinned()), ("pinned", reader)]
    names = ["request_cleaned", "date", "agency", "location", "complaint", "status", "requests", "aggregation_complaint_by_year",
             "aggregation_channel_by_borough"]
    counts = [
        at.read(name).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(when).alias("moment"), F.lit(name).alias("table_name"), "row_count")
        for when, at in seen for name in names
    ]
    return reduce(DataFrame.unionAll, counts)


# --- dimensions ------------------------------------------------------------------------------------------------------

def events_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar_dim(table(spark, sf_dir, "events"), "ts")


def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = {"o_orderkey": F.col("o_orderkey"), **calendar_parts(F.col("o_orderdate"))}
    return project(table(spark, sf_dir, "orders"), parts)


def code_label_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = label_of(F.col("c_mktsegment"), TEST_AGENCY_TYPES, TEST_AGENCY_DEFAULT)
    return distinct_dim(table(spark, sf_dir, "customer"), "segment_key", ["c_mktsegment"], {"segment_type": kind})


def category_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    category = first_match(F.col("p_name"), TEST_CATEGORIES, TEST_CATEGORY_DEFAULT)
    return distinct_dim(table(spark, sf_dir, "part"), "name_key", ["p_name"], {"category": category})


def surrogate_key_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["l_orderkey", "l_partkey", "l_suppkey"]
    return surrogate_key(table(spark, sf_dir, "lineitem").select(*columns).distinct(), "line_key", columns)


def date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.date(stored(spark, sf_dir).read("request_cleaned"))


def agency_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.agency(stored(spark, sf_dir).read("request_cleaned"), TEST_AGENCY_TYPES)


def location_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.location(stored(spark, sf_dir).read("request_cleaned"))


def complaint_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.complaint(stored(spark, sf_dir).read("request_cleaned"), TEST_CATEGORIES)


def status_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every status that occurs, with its row of the fixed table."""
    store = stored(spark, sf_dir)
    counts = store.read("request_cleaned").groupBy("status").count()
    return counts.join(star.status(spark), F.col("status") == F.col("status_code"), "left").select(
        "status", F.col("count").alias("request_count"), "status_key", "status_label", "is_resolved", "is_pending"
    )


# --- fact ------------------------------------------------------------------------------------------------------------

def lookup_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = stored(spark, sf_dir)
    rows = store.read("request_cleaned").select("request_id", "complaint_type")
    return lookup_key(rows, store.read("complaint"), "complaint_key", {"complaint_type": "complaint_type"})


_PLACE = {"borough": "borough", "incident_zip": "incident_zip", "city": "city"}


def lookup_nullsafe_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = stored(spark, sf_dir)
    rows = store.read("request_cleaned").select("request_id", *_PLACE)
    return lookup_key(rows, store.read("location"), "location_key", _PLACE, ["incident_zip", "city"])


def lookup_salted_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lookup in the form for a dimension too large to broadcast."""
    store = stored(spark, sf_dir)
    rows = store.read("request_cleaned").select("request_id", *_PLACE)
    return lookup_key(
        rows, store.read("location"), "location_key", _PLACE, ["incident_zip", "city"], shuffle=True
    )


def lookup_renamed_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored(spark, sf_dir).read("request_cleaned").select("request_id", "status")
    return lookup_key(rows, star.status(spark), "status_key", {"status": "status_code"})


def hours_to_ship(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lineitem = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    hours = elapsed_hours(F.col("o_orderdate"), F.col("l_shipdate"))
    joined = orders.join(lineitem, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.select("o_orderkey", "l_linenumber", "l_partkey", "l_suppkey", hours.alias("hours"))


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = stored(spark, sf_dir)
    dims = [store.read(name) for name in ("agency", "location", "complaint", "status")]
    return star.requests(store.read("request_cleaned"), *dims)


def join_back_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = stored(spark, sf_dir)
    return join_back(
        store.read("requests").select("request_id", "location_key"), store.read("request_cleaned"), "request_id",
        ["channel"],
    )


# --- roll-ups and reports --------------------------------------------------------------------------------------------

def _star(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    store = stored(spark, sf_dir)
    return [store.read(name) for name in names]


def rollup_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.by_year_order(reports.complaint_by_year(*_star(spark, sf_dir, "requests", "complaint", "date")))


def channel_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From fact and silver."""
    tables = _star(spark, sf_dir, "requests", "request_cleaned", "location")
    return reports.by_borough_order(reports.channel_by_borough(*tables))


def channel_share_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From fact and silver, both stored in buckets by request, so that their join moves nothing."""
    facts, cleaned, places = _star(spark, sf_dir, "requests", "request_cleaned", "location")
    names = [f"{name}_{uuid.uuid4().hex}" for name in ("facts", "cleaned")]
    buckets = buckets_for([facts, cleaned], 8)
    both = [
        save_bucketed(rows, name, "request_id", buckets, scratch_path(spark, name)) for rows, name in zip((facts, cleaned), names)
    ]
    return reports.by_borough_order(reports.channel_by_borough(*both, places))


def channel_share_from_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same without joining two large tables."""
    return reports.by_borough_order(
        reports.channel_by_borough_of(*_star(spark, sf_dir, "request_cleaned", "location"))
    )


def rollup_large_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first roll-up in the form for dimensions too large to broadcast."""
    return reports.complaint_by_year(*_star(spark, sf_dir, "requests", "complaint", "date"), shuffle=True)


def channel_share_large_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second roll-up in that form."""
    return reports.channel_by_borough_of(*_star(spark, sf_dir, "request_cleaned", "location"), shuffle=True)


def ctas_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A roll-up made a catalog table by an analyst's SQL."""
    register_views(stored(spark, sf_dir), "gold_")
    name = f"rollup_{uuid.uuid4().hex}"
    return save_as_table(spark.sql("""
        select category, complaint_type, year, count(*) as request_count
        from gold_requests join gold_complaint using (complaint_key) join gold_date using (date_key)
        group by category, complaint_type, year
    """), name)


def ddl_then_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar, inserted into a declared catalog table."""
    database = f"gold_{uuid.uuid4().hex}"
    create_tables(spark, database, {"date": DATE})
    star.date(stored(spark, sf_dir).read("request_cleaned")).write.insertInto(f"{database}.date")
    return spark.table(f"{database}.date")


def append_empty_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze after a load without rows, which is refused and changes nothing."""
    store = Store(spark, scratch_path(spark, "refused"))
    rows = bronze.append(raw(spark, sf_dir), store)
    try:
        bronze.append(rows.where(F.lit(False)), store)
    except ValueError:
        return bronze.rows(store)
    raise AssertionError("a load without rows was taken")


def lines_share_of_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of the parent's total on another table: lines by return flag within a supplier."""
    counts = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(
        F.count(F.lit(1)).alias("line_count")
    )
    return share_of_parent(counts, "l_suppkey", "line_count", "pct_of_supplier")


def slowest_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.slowest_agencies(*_star(spark, sf_dir, "requests", "agency"))


def count_by_area_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.count_by_borough_year(*_star(spark, sf_dir, "requests", "location", "date"))


def top_types_in_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _star(spark, sf_dir, "requests", "complaint", "location")
    return reports.top_types_in_borough(*tables, TEST_BOROUGH)


def top_types_per_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_types_per_borough(*_star(spark, sf_dir, "requests", "complaint", "location"))


def sql_over_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An analyst's own SQL over the stored tables, with the aggregate inside a window."""
    register_views(stored(spark, sf_dir), "gold_")
    return spark.sql("""
        select borough, category, count(*) as request_count,
               round(100.0d * count(*) / sum(count(*)) over (partition by borough), 1) as pct_of_borough_total,
               round(avg(resolution_hours) filter (where resolution_hours > 0), 1) as avg_resolution_hours
        from gold_requests join gold_complaint using (complaint_key) join gold_location using (location_key)
        group by borough, category
    """)


# --- contract --------------------------------------------------------------------------------------------------------

def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.quality_report(*_star(spark, sf_dir, "requests", "location"), TEST_BOROUGHS)


def _contract_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    names = ("requests", "date", "agency", "location", "complaint", "status")
    return dict(zip(names, _star(spark, sf_dir, *names)))


def contract_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.contract_report(_contract_tables(spark, sf_dir), TEST_BOROUGHS)


def null_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.missing_values(_contract_tables(spark, sf_dir))


def repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.repeated_keys(_contract_tables(spark, sf_dir))


def broken_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.broken_references(_contract_tables(spark, sf_dir))


def raw_key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pk_violations(raw(spark, sf_dir), ["unique_key"])


def orders_without_creditor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Foreign keys that do break: orders against the customers with a positive balance."""
    creditors = table(spark, sf_dir, "customer").where(F.col("c_acctbal") > 0)
    return unmatched(table(spark, sf_dir, "orders"), creditors, "o_custkey", "c_custkey")


def contract_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that break a contract, with all their reasons."""
    lineitem, part, supplier = (table(spark, sf_dir, name) for name in ("lineitem", "part", "supplier"))
    judged = with_reasons(
        lineitem, ["l_shipdate"], ["l_orderkey", "l_linenumber"],
        {"l_partkey": (part.where(F.col("p_size") > 10), "p_partkey"), "l_suppkey": (supplier.where(F.col("s_acctbal") > 0), "s_suppkey")},
        {"small_quantity": F.col("l_quantity") < 45},
    )
    _, refused = split_rows(judged)
    return refused.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.array_join("reasons", ",").alias("reasons"))


def declared_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers under declared constraints: a load with a NULL and one with a repeated key are refused, and change nothing."""
    customer, refused = table(spark, sf_dir, "customer"), 0
    store = Store(spark, scratch_path(spark, "declared"))
    declared = {"required": ["c_custkey", "c_name"], "key": ["c_custkey"]}
    store.write_declared(customer, "customer", **declared)
    nameless = customer.withColumn("c_name", F.when(F.col("c_acctbal") > 0, F.col("c_name")))
    for rows, mode in ((nameless, "overwrite"), (customer, "append")):
        try:
            store.write_declared(rows, "customer", **declared, mode=mode)
        except ValueError:
            refused += 1
    if refused != 2:
        raise AssertionError("a load that breaks the constraints was taken")
    return store.read("customer")


def fk_violation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem, part, supplier = (table(spark, sf_dir, name) for name in ("lineitem", "part", "supplier"))
    return fk_violations(lineitem, {
        "l_partkey": (part.where(F.col("p_size") > 10), "p_partkey"),
        "l_suppkey": (supplier.where(F.col("s_acctbal") > 0), "s_suppkey"),
    })


# --- everything ------------------------------------------------------------------------------------------------------

def full_build_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run into a new store, twice over the same bronze rows; rows per table after that."""
    store = Store(spark, scratch_path(spark, "full-build"))
    rows = bronze.append(raw(spark, sf_dir), store, by="unique_key")
    run.build(store, rows, **RULES)
    tables = run.build(store, rows, **RULES)
    counts = [t.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
              for name, t in {"request_raw": rows, **tables}.items()]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionAll(count)
    return result


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_types_in_area(pin_settings(spark), sf_dir)


_ALL = [
    csv_round_trip, csv_multiline_split, first_orders, contract_report, decode_by_header, bronze_from_csv, json_encode_decode, infer_message_fields, insert_absent, ingest_available_twice,
    streaming_clean, branch_counts, clean_projection, valid_interval_filter, keep_first_per_key, silver_rows, events_calendar,
    date_parts, code_label_dim, category_dim, surrogate_key_scaled, date_dim, agency_dim, location_dim, complaint_dim,
    status_lookup, lookup_left_join, lookup_nullsafe_join, lookup_salted_join, lookup_renamed_key, hours_to_ship, fact,
    join_back_channel, rollup_by_year, channel_share, channel_share_from_silver, lines_share_of_mode, slowest_owners,
    count_by_area_year, top_types_in_area, top_types_per_area, sql_over_views, quality_report, null_violations,
    repeated_keys, broken_references, raw_key_violations, orders_without_creditor, fk_violation_counts,
    full_build_counts, rollup_large_dims, channel_share_large_dims, ctas_rollup, ddl_then_insert, append_empty_refused,
    silver_incremental, rollup_incremental, channel_incremental, surrogate_key_continued, build_switch,
    infer_message_types, channel_share_bucketed, contract_rejects, declared_write,
]


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def pinned(query):
        return lambda spark, sf_dir: query(pin_settings(spark), sf_dir)

    return {query.__name__: pinned(query) for query in _ALL}
