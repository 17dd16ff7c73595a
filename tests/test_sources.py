"""Files, messages, tables. Database and broker paths are checked up to the options they hand to Spark."""

import csv
import random
from types import SimpleNamespace

import pytest
from conftest import plan_of, request, values
from pyspark.sql import functions as F

from civiclake import rules, schemas
from civiclake.plans import bronze
from civiclake.plans.views import register_views
from civiclake.sources import csv as csv_source
from civiclake.sources import jdbc, messages
from civiclake.sources.csv import read_csv_text, write_csv_text
from civiclake.sources.tables import Store, create_tables, save_as_table

TEXTS = [("1", 'say "hi", twice'), ("2", "two\nlines\n\nand more"), ("3", " blanks "), ("4", None), ("5", "ü,;"),
         ("6", '"'), ("7", 'a\n"b"\nc'), ("8", "back\\slash\\")]


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame(TEXTS, "Id string, `My Text` string")
    write_csv_text(df.repartition(3), str(tmp_path / "csv"))
    back = read_csv_text(spark, str(tmp_path / "csv"), ["id", "text"])
    assert back.columns == ["id", "text"] and values(back) == TEXTS


@pytest.fixture
def part_bytes(spark):
    """Sets how many bytes of a file one task reads."""
    name = "spark.sql.files.maxPartitionBytes"
    yield lambda size: spark.conf.set(name, str(size))
    spark.conf.unset(name)


FOREIGN = (
    'K, ,K\n1,"x ""y"" z",\n2,,\n\n3,"",a\rb\n   \n4, 007 ,stray " quote\n\r\n5,"two\nlines","and\r\nmore, with ""q""\n\n""end"""\n'
    '6,"a" b,"c"\r\n7,"long ' + "line\n" * 40 + '",x\n8,"""",no end'
)
FOREIGN_ROWS = [
    ("   ", None, None), ("1", 'x "y" z', None), ("2", None, None), ("3", None, "a\rb"), ("4", " 007 ", 'stray " quote'),
    ("5", "two\nlines", 'and\r\nmore, with "q"\n\n"end"'), ("7", "long " + "line\n" * 40, "x"), ("8", '"', "no end"),
]


@pytest.mark.parametrize("size", [7, 16, 33, 64, 1 << 20])
def test_rows_do_not_depend_on_how_a_file_is_split(spark, tmp_path, part_bytes, size):
    (tmp_path / "[1] a b.csv").write_bytes(FOREIGN.encode())
    (tmp_path / "c%20d+e{x}.csv").write_bytes(b'K, ,K\n9,"two\nlines",\n')
    part_bytes(size)
    found = [row for row in values(read_csv_text(spark, str(tmp_path), ["k", "v", "w"])) if row[0] != "6"]
    assert found == FOREIGN_ROWS + [("9", "two\nlines", None)]


def test_small_parts_share_tasks(spark, tmp_path, part_bytes):
    """A task reads many parts, one after another, so tasks do not grow in number as the parts get smaller."""
    rows = [(str(k), f"two\nlines {k}") for k in range(1000, 1400)]
    write_csv_text(spark.createDataFrame(rows, "k string, v string").coalesce(1), str(tmp_path / "csv"))
    part_bytes(16)
    found = read_csv_text(spark, str(tmp_path / "csv"), ["k", "v"])
    assert found.rdd.getNumPartitions() < 100 and values(found) == rows


def test_random_files_equal_a_whole_read(spark, tmp_path, part_bytes):
    rng = random.Random(1)
    for k in range(4):
        fields = [["".join(rng.choice('ab,"\n ') for _ in range(rng.randrange(9))) for _ in range(3)] for _ in range(60)]
        rows = [["x" + row[0], *row[1:]] for row in fields]
        folder = tmp_path / str(k)
        folder.mkdir()
        with open(folder / "f.csv", "w", newline="") as file:
            writer = csv.writer(file, lineterminator="\n", quoting=csv.QUOTE_MINIMAL if k % 2 else csv.QUOTE_ALL)
            writer.writerows([["a", "b", "c"], *rows])
        part_bytes(rng.choice((11, 40, 90)))
        assert values(read_csv_text(spark, str(folder), ["a", "b", "c"])) == sorted(
            (tuple(v or None for v in row) for row in rows), key=lambda row: [(v is not None, v) for v in row]
        )


def test_long_records_across_parts(spark, tmp_path, part_bytes, monkeypatch):
    """Pieces too long to keep while a part's start is not known are read once more."""
    monkeypatch.setattr(csv_source, "BORDER", 50)
    long = "".join(f"line {k}\n" for k in range(200))
    rows = [("1", "a"), ("2", long), ("3", 'x "y"'), ("4", "b\n" + long + '"'), ("5", None)]
    write_csv_text(spark.createDataFrame(rows, "k string, v string").coalesce(1), str(tmp_path / "csv"))
    for size in (64, 300, 2000):
        part_bytes(size)
        assert values(read_csv_text(spark, str(tmp_path / "csv"), ["k", "v"])) == rows


def test_a_quote_that_never_closes_is_reported(spark, tmp_path, part_bytes):
    reader = csv_source._Reader(False, csv_source.MOST, "f.csv from byte 0")
    reader.quoted('1,"open')
    with pytest.raises(ValueError, match="f.csv from byte 0"):
        reader.plain(["x" * (1 << 20)] * 200)


def test_rows_come_from_one_scan(spark, tmp_path):
    write_csv_text(spark.createDataFrame(TEXTS, "k string, v string"), str(tmp_path / "csv"))
    plan = plan_of(read_csv_text(spark, str(tmp_path / "csv"), ["k", "v"]))
    assert plan.count("FileScan text") == 1 and plan.count("from_csv") <= 2


def test_one_multi_line_file_is_parsed_by_several_tasks(spark, tmp_path, part_bytes):
    (tmp_path / "big.csv").write_text("K,V\n" + "".join(f'{i},"text\n{i}"\n' for i in range(20_000)))
    part_bytes(20_000)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = read_csv_text(spark, str(tmp_path), ["k", "v"])
    tasks = df.groupBy(F.spark_partition_id()).count().collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(tasks) > 1 and max(row["count"] for row in tasks) < 17_000, tasks
    assert {(r.k, r.v) for r in df.collect()} == {(str(i), f"text\n{i}") for i in range(20_000)}


def test_csv_with_another_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("K,V\n1,x\n")
    with pytest.raises(ValueError, match="2 columns"):
        read_csv_text(spark, str(tmp_path), ["k"])
    (tmp_path / "b.csv").write_text("V,K\ny,2\n")
    with pytest.raises(Exception, match="header"):
        read_csv_text(spark, str(tmp_path), ["k", "v"]).collect()


def test_messages(spark):
    df = spark.createDataFrame([("1", "a", None), (" 2 ", "", "q"), ("  ", "x", "y"), (None, "x", "y")],
                               "unique_key string, city string, zip string")
    encoded = messages.encode_messages(df, "unique_key")
    assert values(encoded, "key") == [("1",), ("2",)]
    assert values(messages.decode_messages(encoded, ["unique_key", "city", "zip"])) == [(" 2 ", None, "q"), ("1", "a", None)]
    assert values(messages.field_names(encoded)) == [("city",), ("unique_key",), ("zip",)]
    assert values(messages.decode_inferred(encoded)) == [(None, " 2 ", "q"), ("a", "1", None)]


def test_fields_are_found_by_name(spark):
    bodies = ['{"City":"c","Unique Key":"1"}', '{"Unique Key":"2","City":"","Other":"o"}', "no json", "[1]", None]
    df = spark.createDataFrame([(None, body) for body in bodies], schemas.MESSAGE)
    fields = messages.header_fields(["unique_key", "city"])
    got = messages.decode_messages(df, ["unique_key", "city"], fields)
    assert values(got) == [(None, None)] * 3 + [("1", "c"), ("2", None)]
    assert values(messages.field_names(df)) == [("City",), ("Other",), ("Unique Key",)]
    raw = spark.createDataFrame([(bytearray(b'{"city":"b"}'),)], "value binary")
    assert values(messages.decode_messages(raw, ["city"])) == [("b",)]


def test_fields_in_file_order(spark):
    bodies = ['{"B":"2"}', '{"Key No":"1","Town (old)":"x","B":"3"}', '{"Key No":"5","Town (old)":"y","B":"4"}']
    df = spark.createDataFrame([(None, body) for body in bodies], schemas.MESSAGE).coalesce(1)
    columns = ["key_no", "town", "b"]
    fields = messages.ordered_fields(df, columns)
    assert fields == {"key_no": "Key No", "town": "Town (old)", "b": "B"}
    assert values(messages.decode_messages(df, columns, fields)) == [(None, None, "2"), ("1", "x", "3"), ("5", "y", "4")]
    with pytest.raises(ValueError, match="2 fields"):
        messages.ordered_fields(df, ["a", "b"])
    mixed = df.union(spark.createDataFrame([(None, '{"B":"4","Key No":"5","Town (old)":"y"}')], schemas.MESSAGE))
    with pytest.raises(ValueError, match="order"):
        messages.ordered_fields(mixed, columns)


def test_fields_are_matched_or_refused(spark):
    bodies = ['{"BBL":"1","X Coordinate (State Plane)":"2"}', '{"Complaint Type":"3","bbl":null}', "no json", None]
    df = spark.createDataFrame([(None, body) for body in bodies[:1]], schemas.MESSAGE)
    known = {"x_coordinate": "X Coordinate (State Plane)"}
    fields = messages.matched_fields(df, ["x_coordinate", "bbl"], known)
    assert values(messages.decode_messages(df, ["x_coordinate", "bbl"], fields)) == [("2", "1")]
    for columns, told in ((["bbl"], "X Coordinate"), (["x_coordinate", "bbl", "borough"], "borough")):
        with pytest.raises(ValueError, match=told):
            messages.matched_fields(df, columns, known if len(columns) > 1 else None)
    both = spark.createDataFrame([(None, body) for body in bodies], schemas.MESSAGE)
    with pytest.raises(ValueError, match="several: .'bbl'"):
        messages.matched_fields(both, ["x_coordinate", "bbl", "problem"], {**known, "problem": "Complaint Type"})


def test_any_number_of_field_names(spark):
    body = F.to_json(F.map_from_entries(F.transform(F.sequence(F.lit(1), F.lit(10_001)), lambda k: F.struct(k.cast("string"), F.lit("")))))
    assert messages.field_names(spark.range(2).select(body.alias("value"))).count() == 10_001


def test_header_names_are_encoded_and_decoded(spark, bronze_rows):
    rows = bronze_rows(request("1"), request("2", city=None))
    fields = messages.header_fields(rules.RAW_COLUMNS)
    encoded = messages.encode_messages(rows, "unique_key", fields)
    assert '"Unique Key":"1"' in encoded.orderBy("key").first().value
    assert values(bronze.load(spark, "messages", messages=encoded, fields=fields)) == values(rows)


def test_bronze(spark, bronze_rows, tmp_path):
    rows = bronze_rows(request("1"), request("2", city="two\nlines"))
    write_csv_text(rows, str(tmp_path / "in"))
    store = Store(spark, str(tmp_path / "store"))
    bronze.append(bronze.load(spark, "csv", path=str(tmp_path / "in")), store)
    bronze.append(bronze.load(spark, "csv", path=str(tmp_path / "in")), store)
    assert store.read("request_raw").schema == schemas.BRONZE
    assert values(store.read("request_raw")) == sorted(values(rows) * 2, key=str)
    with pytest.raises(ValueError, match="no rows"):
        bronze.append(rows.limit(0), store)
    with pytest.raises(ValueError, match="unknown source"):
        bronze.load(spark, "ftp")


def test_insert_absent(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    more = spark.createDataFrame([(2, "other"), (3, "d"), (3, "c")], "k int, v string")
    assert not store.exists("t")
    unknown = spark.createDataFrame([(None, "n"), (1, "x")], "k int, v string")
    for rows in (first, more, more, first, unknown, unknown):
        store.insert_absent(rows, "t", ["k"])
    assert store.exists("t") and values(store.read("t")) == [(None, "n"), (1, "a"), (2, "b"), (3, "c")]


def test_catalog_tables(spark, bronze_rows):
    create_tables(spark, "gold")
    create_tables(spark, "gold")
    assert {t.name for t in spark.catalog.listTables("gold") if not t.isTemporary} == set(schemas.TABLES)
    assert spark.table("gold.requests").schema == schemas.REQUESTS
    saved = save_as_table(spark.range(3).selectExpr("cast(id as int) as year", "id * 2 as n"), "gold.saved")
    assert values(saved) == [(0, 0), (1, 2), (2, 4)]
    spark.sql("create table gold.from_query using parquet as select year, n from gold.saved where n > 0")
    assert spark.table("gold.from_query").count() == 2


def test_views(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    rows = spark.createDataFrame([(1, 20150101, 1, None, 1, 1, 3)], schemas.REQUESTS)
    store.write(rows, "requests")
    register_views(store, "v_")
    assert spark.sql("select sum(resolution_hours) as s from v_requests").first().s == 3


class Recorder:
    """Stands where Spark's reader or writer would, and notes what it is asked."""

    def __init__(self):
        self.calls = []

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls.append((name, args, kwargs))
            return self

        return call


class Session:
    def __init__(self):
        self.read = self.write = Recorder()


def test_jdbc_options():
    session = Session()
    jdbc.read_jdbc(session, "url", "t", {"user": "u"}, "id", 1, 100, 8)
    jdbc.read_jdbc(session, "url", "t", {"user": "u"})
    split, plain = session.read.calls
    assert split[2] == {"column": "id", "lowerBound": 1, "upperBound": 100, "numPartitions": 8, "properties": {"user": "u"}}
    assert plain[1:] == (("url", "t"), {"properties": {"user": "u"}})
    with pytest.raises(ValueError):
        jdbc.read_jdbc(session, "url", "t", {}, split_on="id")
    session = Session()
    jdbc.write_jdbc(session, "url", "t", {}, "overwrite")
    names = [call[0] for call in session.write.calls]
    assert names == ["mode", "options", "jdbc"] and session.write.calls[1][2]["batchsize"] == 10_000
    with pytest.raises(ValueError):
        jdbc.write_jdbc(session, "url", "t", {}, "ignore")


def test_jdbc_bounds(monkeypatch):
    asked, bounds = [], [3, 90]
    reader = SimpleNamespace(jdbc=lambda url, table, properties: SimpleNamespace(first=lambda: bounds))
    monkeypatch.setattr(jdbc, "read_jdbc", lambda *given: asked.append(given[1:]))
    jdbc.read_jdbc_by_key(SimpleNamespace(read=reader), "url", "t", {}, "id", 4)
    bounds[:] = [None, None]
    jdbc.read_jdbc_by_key(SimpleNamespace(read=reader), "url", "t", {}, "id", 4)
    assert asked == [("url", "t", {}, "id", 3, 90, 4), ("url", "t", {})]


def test_export_options(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    store.write(spark.createDataFrame([(1, "X", "x", True, False)], schemas.STATUS), "status")
    calls = []
    monkeypatch.setattr(jdbc, "write_jdbc", lambda df, *rest: calls.append((values(df), *rest)))
    jdbc.export(store, "url", {"user": "u"}, ["status"])
    assert calls == [([(1, "X", "x", True, False)], "url", "gold.status", {"user": "u"}, "overwrite", 16)]


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="kafka"):
        messages.read_kafka(spark, "localhost:1", "t")
