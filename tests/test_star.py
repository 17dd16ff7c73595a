"""Dimensions, lookups and the fact on hand-made rows."""

import pytest
from conftest import plan_of, request, values
from pyspark.sql import functions as F

from civiclake import schemas
from civiclake.operators import lookups
from civiclake.operators.lookups import data_bytes, join_back, lookup_key, unmatched
from civiclake.plans import run, star
from civiclake.plans.silver import silver
from civiclake.sources.tables import Store


@pytest.fixture
def build(spark, bronze_rows, tmp_path):
    def make(*rows):
        store = Store(spark, str(tmp_path / "store"))
        return run.build(store, store.write(bronze_rows(*rows), "request_raw"))

    return make


def test_tables_have_the_declared_schemas(build):
    tables = build(request("1"), request("2", closed="01/09/2015 01:00:00 AM"))
    for name, table in tables.items():
        assert table.schema == schemas.TABLES[name], name


def test_two_names_of_one_agency_do_not_multiply_facts(build):
    tables = build(
        request("1", agency_name="n1"), request("2", agency_name="n2"), request("3", agency_name=None),
        request("4", agency=None),
    )
    assert values(tables["agency"], "agency_key", "agency_code", "agency_name") == [
        (1, None, "Police"), (2, "NYPD", None), (3, "NYPD", "N1"), (4, "NYPD", "N2"),
    ]
    assert values(tables["requests"], "request_id", "agency_key") == [(1, 3), (2, 4), (3, 2), (4, None)]


def test_places(build):
    tables = build(
        request("1", city="c1"), request("2", city="c2"),                        # one zip, two cities
        request("3", city="c1", incident_zip=None), request("4", city="c1", incident_zip="N/A"),
        request("5", borough="Unspecified"), request("6", borough=None),
        request("7", city=None),
        request("8", city="c1", latitude="40", longitude="-70"), request("9", city="c1", latitude="42"),
    )
    assert values(tables["location"], "location_key", "incident_zip", "city", "latitude", "longitude") == [
        (1, None, "C1", None, None), (2, "1", None, None, None), (3, "1", "C1", 41.0, -70.0),
        (4, "1", "C2", None, None), (5, "N/A", "C1", None, None),
    ]
    assert values(tables["requests"], "request_id", "location_key") == [
        (1, 3), (2, 4), (3, 1), (4, 5), (5, None), (6, None), (7, 2), (8, 3), (9, 3),
    ]


def test_one_calendar_row_per_day(build):
    tables = build(
        request("1", created="01/02/2015 12:00:00 AM"), request("2", created="01/02/2015 05:00:00 AM"),
        request("3", created="x"),
    )
    assert values(tables["date"], "date_key") == [(20150102,)]
    assert values(tables["requests"], "request_id", "date_key") == [(1, 20150102), (2, 20150102), (3, None)]
    assert values(tables["aggregation_complaint_by_year"], "year", "request_count") == [(2015, 2)]


def test_unknown_type_and_status(build):
    tables = build(request("1", problem=None), request("2", status="lost"), request("3", status=" in progress"))
    assert values(tables["complaint"]) == [(1, None, "Other"), (2, "Noise", "Noise")]
    assert values(tables["requests"], "request_id", "complaint_key", "status_key") == [
        (1, None, 2), (2, 2, None), (3, 2, 4),
    ]


def test_hours_and_their_mean(build):
    tables = build(
        request("1", closed="01/02/2015 01:29:00 AM"), request("2", closed="01/02/2015 01:31:00 AM"),
        request("3", closed="01/02/2015 03:00:00 AM"), request("4"),
        request("5", problem="Mold", closed="01/02/2015 01:10:00 AM"),
    )
    assert values(tables["requests"], "request_id", "resolution_hours") == [(1, 0), (2, 1), (3, 2), (4, None), (5, 0)]
    rollup = values(tables["aggregation_complaint_by_year"], "complaint_type", "request_count", "avg_resolution_hours")
    assert rollup == [("Mold", 1, None), ("Noise", 4, 1.5)]


def test_second_run_changes_nothing(spark, bronze_rows, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    rows = store.write(bronze_rows(request("1"), request("2", borough="bronx"), request("2")), "request_raw")
    first = {name: values(table) for name, table in run.build(store, rows).items()}
    second = {name: values(table) for name, table in run.build(store, rows).items()}
    assert first == second and len(first["requests"]) == 2


def test_status_table(spark):
    status = star.status(spark)
    assert [f.dataType for f in status.schema] == [f.dataType for f in schemas.STATUS]
    assert values(status, "status_key", "status_code", "is_resolved", "is_pending") == [
        (1, "CLOSED", True, False), (2, "OPEN", False, True), (3, "PENDING", False, True),
        (4, "IN PROGRESS", False, True), (5, "ASSIGNED", False, True), (6, "UNSPECIFIED", False, False),
    ]


# --- lookups ---------------------------------------------------------------------------------------------------------

def lookup_tables(spark):
    fact = spark.range(600).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("v"), F.col("id") % 50))
        .alias("a"),                                                           # a third hot, a third NULL
        F.when(F.col("id") % 2 == 0, "x").alias("b"),
    )
    dim = spark.createDataFrame(
        [(1, "hot", "x"), (2, "hot", None), (3, "v1", "x"), (4, "v7", None), (5, None, "x")], "k long, da string, db string"
    )
    return fact, dim


def brute_force(fact, dim):
    dims = [tuple(row) for row in dim.collect()]
    return sorted(
        (r.id, r.a, r.b, next((k for k, a, b in dims if r.a is not None and a == r.a and b == r.b), None))
        for r in fact.collect()
    )


@pytest.mark.parametrize("shuffle", [False, True])
def test_lookup_against_brute_force(spark, shuffle):
    fact, dim = lookup_tables(spark)
    got = lookup_key(fact, dim, "k", {"a": "da", "b": "db"}, ["b"], shuffle=shuffle)
    assert got.columns == ["id", "a", "b", "k"]
    assert sorted(tuple(row) for row in got.collect()) == brute_force(fact, dim)


def test_large_dimension_is_not_broadcast_and_hot_rows_are_dealt_out(spark, nothing_is_small):
    fact, dim = lookup_tables(spark)
    got = lookup_key(fact, dim, "k", {"a": "da", "b": "db"}, ["b"])
    plan = plan_of(got)
    rows = sorted(tuple(row) for row in got.collect())
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    exchange = next(line for line in plan.splitlines() if "Exchange hashpartitioning(_key_a" in line)
    assert "_salt" in exchange
    assert rows == brute_force(fact, dim)


def test_hot_values_are_bounded(spark):
    fact, _ = lookup_tables(spark)
    hot = lookups._hot_values(fact, ["a", "b"]).collect()
    assert {(r._hot_a, r._hot_b) for r in hot} >= {("hot", "x"), ("hot", None), (None, "x"), (None, None)}
    assert len(hot) < lookups.HOT_SHARE


def test_data_bytes_grows_with_text(spark):
    small, large = spark.createDataFrame([("a",)], "t string"), spark.createDataFrame([("a" * 1000,)], "t string")
    assert data_bytes(large) - data_bytes(small) == 999
    nested = spark.range(10).selectExpr("transform(sequence(1, 10000), k -> k / 7d) as a", "named_struct('b', cast('x' as binary)) as s")
    assert data_bytes(nested) >= 10 * 10_000 * 8
    assert data_bytes(small.limit(0)) == 0


def test_fact_is_built_without_a_shuffle(spark, bronze_rows, tmp_path):
    store = Store(spark, str(tmp_path / "plan"))
    tables = run.build(store, store.write(bronze_rows(request("1")), "request_raw"))
    dims = [tables[name] for name in ("agency", "location", "complaint", "status")]
    plan = plan_of(star.requests(tables["request_cleaned"], *dims))
    assert plan.count("BroadcastHashJoin") == 4 and "Exchange hashpartitioning" not in plan


def test_fact_is_the_same_with_large_dimensions(spark, bronze_rows, tmp_path, nothing_is_small):
    rows = [request(str(i), city=f"c{i % 7}" if i % 5 else None, agency_name=None if i % 3 else f"a{i % 4}",
                    borough="queens" if i % 2 else "unspecified", status="open" if i % 6 else "lost") for i in range(90)]
    store = Store(spark, str(tmp_path / "large"))
    tables = run.build(store, store.write(bronze_rows(*rows), "request_raw"))
    large = values(tables["requests"])
    sums = [values(tables[name]) for name in ("aggregation_complaint_by_year", "aggregation_channel_by_borough")]
    nothing_is_small()
    tables = run.build(store, store.read("request_raw"))
    assert values(tables["requests"]) == large
    assert sums == [values(tables[name]) for name in
                    ("aggregation_complaint_by_year", "aggregation_channel_by_borough")]


def test_join_back_never_multiplies(spark):
    fact = spark.createDataFrame([(1, 10), (1, 11), (2, 12), (None, 13), (9, 14)], "id long, v int")
    source = spark.createDataFrame([(1, "b"), (1, "a"), (2, None), (None, "z")], "id long, channel string")
    assert values(join_back(fact, source, "id", ["channel"])) == [(1, 10, "a"), (1, 11, "a"), (2, 12, None)]


def test_unmatched(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,), (None,), (5,), (5,)], "fk int")
    dim = spark.createDataFrame([(2,), (3,)], "pk int")
    assert values(unmatched(fact, dim, "fk", "pk")) == [(1, 2), (5, 2)]


def test_silver_and_fact_have_the_same_rows(spark, bronze_rows, tmp_path):
    rows = bronze_rows(*[request(str(i), city=f"c{i % 4}", agency_name=f"a{i % 5}") for i in range(60)])
    cleaned = silver(rows)
    store = Store(spark, str(tmp_path / "rows"))
    store.write(cleaned, "request_cleaned")
    tables = run.build_star(store)
    assert tables["requests"].count() == cleaned.count() == 60
