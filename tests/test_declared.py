"""Typed messages, bucketed tables, declared constraints, and rows that break a contract."""

import uuid

import pytest
from conftest import plan_of, values
from pyspark.sql import functions as F

from civiclake.operators.quality import split_rows, with_reasons
from civiclake.plans import checks, run
from civiclake.schemas import MESSAGE
from civiclake.sources import tables
from civiclake.sources.messages import decode_typed, message_types
from civiclake.sources.tables import Store, save_bucketed
from test_versions import batches


def as_messages(spark, bodies):
    return spark.createDataFrame([(None, body) for body in bodies], MESSAGE).repartition(3)


def test_types_are_merged_over_all_messages(spark):
    bodies = [
        '{"n":1,"x":1,"b":true,"o":{"a":1},"l":[1,2],"s":"t","never":null,"VARIANT":1,"odd `name: VOID":2}',
        '{"n":2,"x":1.5,"b":false,"o":{"a":2.5,"c":"z"},"l":[3.5],"s":7,"n2":12345678901234567890}', "no json", "[1]", '"text"', None, "{}",
    ]
    messages = as_messages(spark, bodies)
    rows = decode_typed(messages.where("value like '{%'"))
    types = dict(rows.dtypes)
    assert [types[name] for name in ("n", "x", "b", "s", "never", "VARIANT", "odd `name: VOID")] == [
        "bigint", "double", "boolean", "string", "string", "bigint", "bigint"]
    assert types["o"] == "struct<a:double,c:string>" and types["l"] == "array<double>" and types["n2"] == "double"
    assert values(rows, "n", "x", "s") == [(None, None, None), (1, 1.0, "t"), (2, 1.5, "7")]
    assert decode_typed(messages).count() == len(bodies)


def test_no_message_with_a_field(spark):
    for bodies in ([], ["{}", "[1]", None]):
        messages = as_messages(spark, bodies) if bodies else spark.createDataFrame([], MESSAGE)
        assert message_types(messages) == "STRUCT<>"
        with pytest.raises(ValueError, match="no message"):
            decode_typed(messages)


def test_bucketed_tables_are_joined_where_they_lie(spark, tmp_path, nothing_is_small):
    names = [f"b{k}_{uuid.uuid4().hex}" for k in range(2)]
    rows = spark.range(100).select("id", (F.col("id") % 7).alias("v"))
    left, right = (save_bucketed(rows, name, "id", 4, str(tmp_path / name)) for name in names)
    unique = right.groupBy("id").agg(F.min("v").alias("w"))
    plan = plan_of(left.join(unique, "id"))
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert left.join(unique, "id").count() == 100
    for name in names:
        spark.sql(f"drop table {name}")


def test_buckets_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(tables, "BUCKET_BYTES", 1000)
    few = spark.range(10)
    assert [tables.buckets_for([few, spark.range(rows)], 8) for rows in (100, 1000, 10000)] == [8, 16, 256]


def test_a_write_that_breaks_its_constraints_changes_nothing(spark, tmp_path):
    store, schema = Store(spark, str(tmp_path)), "k int, v string"
    declared = {"required": ["v"], "key": ["k"]}
    good = spark.createDataFrame([(1, "a"), (None, "b")], schema)
    store.write_declared(good, "t", **declared)
    for rows, told in (([(2, None)], "required"), ([(2, "x"), (2, "y")], "twice"), ([(None, "x")], "twice")):
        with pytest.raises(ValueError, match=told):
            store.write_declared(spark.createDataFrame(rows, schema), "t", **declared, mode="append")
        assert values(store.read("t")) == values(good)
    store.write_declared(spark.createDataFrame([(2, "c")], schema), "t", **declared, mode="append")
    assert store.read("t").count() == 3


def test_reasons(spark):
    dim = spark.createDataFrame([("a",), ("b",)], "d string")
    rows = spark.createDataFrame(
        [(1, "a", 5, "x"), (2, "z", None, None), (2, "a", -1, "x"), (None, None, 1, "x"), (None, "b", 1, "x")], "k int, r string, n int, v string"
    )
    judged = with_reasons(rows, ["k", "v"], ["k"], {"r": (dim, "d")}, {"n_positive": F.col("n") > 0})
    accepted, refused = split_rows(judged)
    assert values(accepted) == [(1, "a", 5, "x")]
    found = sorted((str(row["k"]), str(row["r"]), ",".join(row["reasons"])) for row in refused.collect())
    assert found == [
        ("2", "a", "n_positive,unique.k"), ("2", "z", "reference.r,required.v,unique.k"), ("None", "None", "required.k,unique.k"),
        ("None", "b", "required.k,unique.k"),
    ]


def test_reasons_agree_with_the_report(spark, bronze_rows, tmp_path):
    tables = run.build(Store(spark, str(tmp_path)), bronze_rows(*[row for batch in batches() for row in batch]))
    tables["location"] = tables["location"].limit(1)
    report = {row.metric: row.value for row in checks.contract_report(tables).collect()}
    reasons = checks.judged_requests(tables).select(F.explode("reasons").alias("reason")).groupBy("reason").count().collect()
    counts = {row["reason"]: row["count"] for row in reasons}
    assert counts["reference.location_key"] == report["reference.requests.location_key"] > 0
    assert counts.get("required.request_id", 0) == report["required.requests.request_id"]
