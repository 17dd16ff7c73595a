"""Service requests derived from the given tables: one raw, all-text row per order and line, dirt included.

The same select list serves Spark and DuckDB; the dialect tables hold the three words that differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.operators.lookups import fits_broadcast
from civiclake.rules import RAW_COLUMNS

# Dirt goes by order, so that all rows of one key are dirty alike; the moduli are primes, so that kinds of dirt meet.
_FILLED = {
    # a decimal tail, blanks around, a blank key, a key that is no number
    "unique_key": "case when o_orderkey % 97 = 5 then cast(o_orderkey as {text}) || '.0'"
                  " when o_orderkey % 97 = 6 then cast(o_orderkey as {text}) || '.75 '"
                  " when o_orderkey % 97 = 7 then ' ' || cast(o_orderkey as {text})"
                  " when o_orderkey % 89 = 13 then '  ' when o_orderkey % 89 = 33 then 'SR-' || cast(o_orderkey as {text})"
                  " else cast(o_orderkey as {text}) end",
    # another format, a day and an hour that do not exist, a word
    "created_date": "case when o_orderkey % 83 = 1 then '1996-02-28 10:00:00'"
                    " when o_orderkey % 83 = 2 then '02/30/1996 10:00:00 AM' when o_orderkey % 83 = 3 then 'unknown'"
                    " else {clock}(o_orderdate + interval '1' day * coalesce(l_linenumber, 0)"
                    " + interval '1' minute * (coalesce(l_suppkey, 0) % 1440), {format}) end",
    "closed_date": "case when o_orderkey % 79 = 4 then '03/05/1996 13:10:00 PM' when o_orderkey % 79 = 34 then ' '"
                   " else {clock}(l_shipdate + interval '1' minute * (l_partkey % 1440), {format}) end",
    "agency": "' ' || lower(c_mktsegment) || ' '",
    # up to two names and none for one code
    "agency_name": "case when o_orderkey % 41 = 1 then null when o_orderkey % 10 = 3 then c_mktsegment || ' division '"
                   " else c_mktsegment || ' DEPT' end",
    "problem": "case when o_orderkey % 73 = 6 then null else p_name end",
    "problem_detail": "p_type",
    # blanks, and a word that some data has in place of none
    "incident_zip": "case when n_nationkey % 5 = 0 then '  ' when o_orderkey % 11 = 2 then 'N/A'"
                    " else ' 1' || lpad(cast(n_nationkey as {text}), 4, '0') end",
    "incident_address": "upper(s_name) || ' '",
    "city": "case when o_orderkey % 13 = 1 then null else n_name end",
    "status": "case when o_orderkey % 61 = 7 then 'In Limbo' when o_orderkey % 61 = 37 then null"
              " else case o_orderstatus when 'F' then 'Closed' when 'O' then 'open ' else 'Pending' end end",
    "borough": "case when o_orderkey % 53 = 4 then null when r_name = 'MIDDLE EAST' then 'Unspecified'"
               " else lower(r_name) || ' ' end",
    "open_data_channel_type": "case when o_orderpriority = '4-NOT SPECIFIED' then null"
                              " else substr(lower(o_orderpriority), 3) end",
    "latitude": "case when l_linenumber = 7 then '0' when o_orderkey % 71 = 3 then 'n/a'"
                " else cast(cast(s_suppkey + 1 as int) as {text}) end",
    "longitude": "cast(0 - l_partkey % 180 as {text}) || case when o_orderkey % 2 = 0 then '.25' else '' end",
}

_SPARK = {"text": "string", "clock": "date_format", "format": "'MM/dd/yyyy hh:mm:ss a'"}
_DUCKDB = {"text": "varchar", "clock": "strftime", "format": "'%m/%d/%Y %I:%M:%S %p'"}


def _select_list(dialect: dict[str, str]) -> list[str]:
    absent = "cast(null as {text})"
    return [f"{_FILLED.get(name, absent).format(**dialect)} as {name}" for name in RAW_COLUMNS]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df) else df


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw rows: orders without lines count too, as open requests.

    Lines are moved by part while they are narrow, then once by order. Places and suppliers come last, so their texts are not moved
    where they are measured to be small.
    """
    orders, customer, nation, region, lineitem, part, supplier = (
        table(spark, sf_dir, name)
        for name in ("orders", "customer", "nation", "region", "lineitem", "part", "supplier")
    )
    places = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "n_name", "r_name")
    suppliers = supplier.select("s_suppkey", "s_name")
    lines = lineitem.join(part, lineitem.l_partkey == part.p_partkey, "left")
    rows = (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .join(_small(places), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(_small(suppliers), F.col("l_suppkey") == F.col("s_suppkey"), "left")
    )
    return rows.selectExpr(*_select_list(_SPARK))


RAW_SQL = f"""select {", ".join(_select_list(_DUCKDB))}
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
join region on n_regionkey = r_regionkey left join lineitem on o_orderkey = l_orderkey
left join part on l_partkey = p_partkey left join supplier on l_suppkey = s_suppkey"""

# Rule tables that fit the test data's names.
TEST_AGENCY_TYPES = {"Industry": ["AUTOMOBILE", "MACHINERY"], "Home": ["HOUSEHOLD", "FURNITURE"]}
TEST_AGENCY_DEFAULT = "Other"
TEST_CATEGORIES = [("(?i)ring|rod", "Round"), ("(?i)old", "Old"), ("(?i)gear|bolt", "Fasten")]
TEST_CATEGORY_DEFAULT = "Other"
TEST_BOROUGHS = ["AFRICA", "AMERICA", "ASIA", "EUROPE"]
TEST_BOROUGH = "ASIA"
