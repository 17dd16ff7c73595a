"""Dense numbering over many partitions."""

from types import SimpleNamespace

import pytest
from conftest import plan_of, values
from pyspark.sql import Window
from pyspark.sql import functions as F

from civiclake.operators.numbering import surrogate_key
from civiclake.session import scratch_path


@pytest.fixture
def many_parts(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def check(df, order):
    got = surrogate_key(df, "k", order)
    expected = df.withColumn("k", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    assert values(got, "k", *df.columns) == values(expected, "k", *df.columns)
    return got


def test_equals_the_plain_window(many_parts):
    spark = many_parts
    hashed = spark.range(5000).select(
        F.when(F.col("id") % 3 > 0, F.col("id") % 7).alias("a"), F.xxhash64("id").alias("b")  # NULL in a third
    )
    got = check(hashed, ["a", "b"])
    plan = plan_of(got)
    assert "SinglePartition" not in plan.split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning" not in plan.split("BroadcastExchange")[0], "rows are not shuffled again"


def test_really_used_several_partitions(many_parts):
    spark = many_parts
    got = surrogate_key(spark.range(5000), "k", ["id"])
    assert len(got.inputFiles()) > 1
    assert [(r.k, r.id) for r in got.orderBy("k").collect()] == [(i + 1, i) for i in range(5000)]


@pytest.mark.parametrize("rows", [0, 1])
def test_small_tables(spark, rows):
    check(spark.range(rows), ["id"])


def test_texts_and_nulls_first(spark):
    df = spark.createDataFrame([("b", None), ("a", "z"), (None, "q"), ("a", None)], "x string, y string")
    got = check(df, ["x", "y"])
    assert [(r.x, r.y) for r in got.orderBy("k").collect()] == [(None, "q"), ("a", None), ("a", "z"), ("b", None)]


class Session:
    """Only the settings a session tells."""

    def __init__(self, master, settings):
        self.conf, self.sparkContext = settings, SimpleNamespace(master=master, applicationId=f"app-{id(self)}")


def test_scratch_is_in_the_folder_the_cluster_names():
    cluster = Session("spark://host:7077", {"spark.checkpoint.dir": "hdfs://shared/folder/"})
    first, second = scratch_path(cluster, "x"), scratch_path(cluster, "x")
    assert first.startswith("hdfs://shared/folder/civiclake/x-") and first != second
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(Session("yarn", {}), "x")
    assert scratch_path(Session("local[2]", {}), "x")
