"""The steps as a user runs them."""

import json

import pytest
from conftest import request, values

from civiclake.__main__ import main
from civiclake.plans import bronze
from civiclake.schemas import MESSAGE
from civiclake.sources.csv import write_csv_text
from civiclake.sources.tables import Store


@pytest.fixture
def folders(spark, bronze_rows, tmp_path):
    rows = bronze_rows(
        request("1", closed="01/03/2015 01:00:00 AM", resolution_description="two\nlines"), request("2"), request("2"),
        request(" ", city="no key"), request("3", borough="bronx", problem="Illegal Parking"),
    )
    write_csv_text(rows, str(tmp_path / "in"))
    return {name: str(tmp_path / name) for name in ("in", "messages", "store", "other", "out")}


def test_all_steps_at_once_and_one_by_one(spark, folders, capsys):
    assert main(["all", "--store", folders["store"], "--csv", folders["in"]], spark) == 1
    told = capsys.readouterr().out
    # a blank key is a key to silver, but no identifier to the contract
    assert "row_count: 4.0 > 0.0 passed" in told and "required.requests.request_id: 1.0 = 0.0 FAILED (error)" in told
    assert told.count("FAILED (error)") == 1
    for step in ("bronze", "silver", "star", "rollups"):
        assert main([step, "--store", folders["other"], "--csv", folders["in"]], spark) == 0
    assert main(["check", "--store", folders["other"]], spark) == 1
    for table in ("request_cleaned", "requests", "location", "aggregation_channel_by_borough"):
        assert values(Store(spark, folders["store"]).read(table)) == values(Store(spark, folders["other"]).read(table))
    main(["sql", "--store", folders["other"], "--query",
          "select borough, count(*) as n from requests join location using (location_key) group by borough"], spark)
    assert "BRONX" in capsys.readouterr().out
    main(["sql", "--store", folders["other"], "--query", "select id from range(150)"], spark)
    assert len(capsys.readouterr().out.split()) == 1 + 150
    main(["sql", "--store", folders["other"], "--query", "select id from range(150)", "--output", folders["out"]], spark)
    assert spark.read.parquet(folders["out"]).count() == 150


@pytest.mark.parametrize("table, broken, rule", [
    ("date", "select date_key, full_date, year, month, quarter, day_of_week, is_weekend, cast(null as string) season from date",
     "required.date.season"),
    ("agency", "select * from agency union all select * from agency", "unique.agency"),
    ("complaint", "select * from complaint where complaint_type <> 'Noise'", "reference.requests.complaint_key"),
])
def test_a_broken_rule_fails_the_check(spark, folders, capsys, table, broken, rule):
    main(["all", "--store", folders["store"], "--csv", folders["in"]], spark)
    main(["sql", "--store", folders["store"], "--query", broken, "--output", folders["out"]], spark)
    Store(spark, folders["store"]).write(spark.read.parquet(folders["out"]), table)
    capsys.readouterr()
    assert main(["check", "--store", folders["store"]], spark) == 1
    assert any(line.startswith(rule + ":") and "FAILED" in line for line in capsys.readouterr().out.splitlines())


def test_an_empty_load_leaves_no_bronze_rows(spark, folders, bronze_rows):
    write_csv_text(bronze_rows(request("1")).limit(0), folders["other"])
    with pytest.raises(ValueError, match="no rows"):
        main(["bronze", "--store", folders["store"], "--csv", folders["other"]], spark)
    with pytest.raises(ValueError, match="no bronze rows"):
        main(["silver", "--store", folders["store"]], spark)


def test_messages_arrive_once_and_join_the_batches(spark, folders):
    store = Store(spark, folders["store"])
    messages = ["--store", folders["store"], "--messages", folders["messages"]]
    with pytest.raises(ValueError, match="no bronze rows"):
        bronze.rows(store)
    main(["publish", *messages, "--csv", folders["in"]], spark)
    main(["ingest", *messages], spark)
    main(["ingest", *messages], spark)
    assert values(bronze.rows(store), "unique_key") == [("1",), ("2",), ("2",), ("3",)]
    main(["bronze", "--store", folders["store"], "--csv", folders["in"]], spark)
    assert bronze.rows(store).count() == 4 + 5
    main(["silver", "--store", folders["store"]], spark)
    assert values(store.read("request_cleaned"), "request_id") == [(None,), (1,), (2,), (3,)]
    main(["publish", *messages, "--csv", folders["in"]], spark)
    main(["ingest", *messages], spark)
    assert bronze.rows(store).count() == 4 + 5 + 4


def test_messages_of_another_producer(spark, folders):
    rows = [json.dumps({f"Header {i}": (str(k) if i == 0 else "01/02/2015 01:00:00 AM" if i == 1 else "")
                        for i in range(44)}) for k in range(3)]
    spark.createDataFrame([(None, row) for row in rows], MESSAGE).write.parquet(folders["messages"])
    for store, step in (("store", "ingest"), ("other", "bronze")):
        main([step, "--store", folders[store], "--messages", folders["messages"], "--fields", "order"], spark)
        loaded = bronze.rows(Store(spark, folders[store]))
        assert values(loaded, "unique_key", "created_date", "location") == [
            (str(k), "01/02/2015 01:00:00 AM", None) for k in range(3)]


def test_failed_rules_are_reported(spark, folders):
    main(["all", "--store", folders["store"], "--csv", folders["in"]], spark)
    store = Store(spark, folders["store"])
    store.write(store.read("requests").limit(0).coalesce(1), "empty")
    other = Store(spark, folders["other"])
    other.write(store.read("empty").select(*store.read("requests").columns), "requests")
    for name in ("date", "agency", "location", "complaint", "status"):
        other.write(store.read(name), name)
    assert main(["check", "--store", folders["other"]], spark) == 1


def test_merge_takes_new_messages_into_silver(spark, folders):
    messages = ["--store", folders["store"], "--messages", folders["messages"]]
    store = Store(spark, folders["store"])
    main(["publish", *messages, "--csv", folders["in"]], spark)
    main(["merge", *messages], spark)
    first = store.tables()
    main(["merge", *messages], spark)
    assert store.tables() == first and values(store.read("request_cleaned"), "request_id") == [(1,), (2,), (3,)]
    main(["publish", *messages, "--csv", folders["in"]], spark)
    main(["merge", *messages], spark)
    assert values(store.read("request_cleaned"), "request_id") == [(1,), (2,), (3,)]
    main(["bronze", "--store", folders["other"], "--csv", folders["in"]], spark)
    main(["silver", "--store", folders["other"]], spark)
    whole = Store(spark, folders["other"]).read("request_cleaned").where("request_id is not null")
    assert values(store.read("request_cleaned")) == values(whole)
