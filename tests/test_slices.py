"""How much disk a step takes at a time: slices of a table, shuffle files, compressed tables."""

import time
from contextlib import contextmanager
from pathlib import Path

from civiclake.plans import bronze, incremental, run
from civiclake.session import pin_settings
from civiclake.sources import csv, tables
from civiclake.sources.csv import read_csv_text, write_csv_text
from civiclake.sources.tables import Store, input_bytes, slices
from conftest import plan_of, request, values
from fixture import queries
from fixture.raw import raw

FOLDER = "/root/testdata/sf0.001"


def test_slices_hold_every_row_once(spark, tmp_path, monkeypatch):
    rows = spark.range(1000).selectExpr("if(id % 5 = 0, null, cast(id as string)) as key", "id")
    assert slices(rows, "key") == [rows], "no files"
    rows.repartition(3).write.parquet(str(tmp_path / "odd [1]{a} name"))
    rows = spark.read.parquet(str(tmp_path / "odd \\[1\\]\\{a\\} name"))
    size = input_bytes(rows)
    assert size == sum(file.stat().st_size for file in (tmp_path / "odd [1]{a} name").glob("*.parquet")) and slices(rows, "key") == [rows]
    monkeypatch.setattr(tables, "SLICE_BYTES", size // 3)
    parts = slices(rows, "key")
    assert len(parts) == 4 and all(0 < part.count() < 500 for part in parts)
    assert sorted(row.id for part in parts for row in part.collect()) == list(range(1000))
    monkeypatch.setattr(tables, "SLICE_BYTES", 1)
    assert len(slices(rows, "key")) == tables.MOST_SLICES


def test_a_slice_of_the_raw_rows_is_cut_before_it_is_moved(spark, nothing_is_small, monkeypatch):
    monkeypatch.setattr(tables, "SLICE_BYTES", input_bytes(raw(spark, FOLDER)) // 2)
    plan = plan_of(slices(raw(spark, FOLDER), "unique_key")[0])
    for column in ("o_orderkey", "l_orderkey"):
        scan = next(line for line in plan.splitlines() if "FileScan" in line and f"{column}#" in line)
        assert "pmod(xxhash64(" in scan, "the filter reaches orders and lines"


def test_tables_built_in_slices_are_the_same(spark, bronze_rows, tmp_path, monkeypatch):
    rows = bronze_rows(*[request(str(k % 40), f"01/{1 + k % 28:02}/2015 01:00:00 AM", problem=f"P{k % 7}") for k in range(120)], request(None))
    stores = [Store(spark, str(tmp_path / name)) for name in ("whole", "sliced")]
    whole = run.build(stores[0], bronze.append(rows, stores[0]))
    rows.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    monkeypatch.setattr(tables, "SLICE_BYTES", 1)
    monkeypatch.setattr(tables, "MOST_SLICES", 3)
    held = bronze.append(rows, stores[1], by="unique_key")
    assert held.count() == 121 and len(stores[1].tables()["request_raw"]) == tables.MOST_SLICES
    sliced = run.build(stores[1], held)
    assert len(stores[1].tables()["request_cleaned"]) == tables.MOST_SLICES
    assert all(values(sliced[name]) == values(whole[name]) for name in whole)
    assert values(stores[1].write(rows, "again", by="unique_key"), "unique_key") == values(rows, "unique_key")


def test_what_a_query_shuffled_is_deleted_when_it_ends(spark, tmp_path):
    pin_settings(spark)
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled() -> set:
        files = disk.getAllFiles()
        return {files.apply(k).getName() for k in range(files.size()) if files.apply(k).getName().startswith("shuffle_")}

    before, moved = shuffled(), spark.range(100_000).repartition(3, "id")
    moved.write.parquet(str(tmp_path / "t"))
    end = time.time() + 20
    while shuffled() - before and time.time() < end:
        time.sleep(0.2)
    assert not shuffled() - before and moved.groupBy("id").count().count() == 100_000
    found = moved.selectExpr("sum(id) as total")
    assert found.collect() == found.collect(), "a plan that is run again works out what is gone"


def test_stored_tables_are_compact(spark, tmp_path):
    Store(spark, str(tmp_path)).write(spark.range(3), "t")
    assert list(tmp_path.glob("data/t/*/*.zstd.parquet"))


def test_compressed_files_are_read_back(spark, tmp_path, monkeypatch):
    """Line breaks in quotes, empty and quoted texts, in files that no task can split."""
    monkeypatch.setattr(csv, "FILE_ROWS", 7)
    texts = ["a\nb", 'say "x"', "", " ", ",", "\r", "\n", "end", None]
    rows = spark.createDataFrame([(str(k), texts[k % len(texts)]) for k in range(50)], "k string, v string").repartition(2)
    write_csv_text(rows, str(tmp_path / "csv"), compressed=True)
    files = [file.name for file in (tmp_path / "csv").glob("part-*")]
    assert len(files) >= 8 and all(name.endswith(".csv.gz") for name in files)
    read = read_csv_text(spark, str(tmp_path / "csv"), ["k", "v"])
    assert values(read) == sorted((str(k), texts[k % len(texts)] or None) for k in range(50))


def test_bronze_files_are_written_compressed_and_in_slices(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "scratch_path", lambda _, label: str(tmp_path / label))
    monkeypatch.setattr(tables, "SLICE_BYTES", input_bytes(raw(spark, FOLDER)) // 2)
    found = queries.bronze_from_csv(spark, FOLDER)
    files = list((tmp_path / "raw-csv").glob("part-*"))
    assert len({file.name.split("-c0")[0].split("-", 2)[2] for file in files}) == 3, "three writes"
    assert all(file.name.endswith(".csv.gz") for file in files)
    texts = raw(spark, FOLDER)
    assert found.count() == texts.count() and found.exceptAll(texts.replace("", None)).isEmpty()


def test_a_merge_in_slices_is_the_same_and_leaves_no_scratch_tables(spark, bronze_rows, tmp_path, monkeypatch):
    batches = [[request(str(k * 17 % 4000 + shift), f"0{1 + (k + shift) % 9}/05/2015 01:00:00 AM", problem=f"P{k % 5}") for k in range(90)]
               + [request("x", borough="bronx"), request(None)] for shift in (0, 17)]
    stores = [Store(spark, str(tmp_path / name)) for name in ("whole", "sliced")]
    monkeypatch.setattr(incremental, "scratch_database", made := Databases())
    for store, most in zip(stores, (1, 2)):
        monkeypatch.setattr(tables, "SLICE_BYTES", 1)
        monkeypatch.setattr(tables, "MOST_SLICES", most)
        for k, batch in enumerate(batches):
            incremental.merge(store, bronze_rows(*batch), f"b{k}", width=3000)
    assert made.dropped == 4 and made.most > 1, "several slices"
    assert values(stores[0].read("request_cleaned")) == values(stores[1].read("request_cleaned"))
    for rollup in (incremental.complaint_by_year, incremental.channel_by_borough):
        assert values(rollup(stores[0])) == values(rollup(stores[1]))


def tables_in(spark, database: str) -> list[str]:
    """Without the temporary views of the session, which are listed with any database."""
    return [row.tableName for row in spark.sql(f"SHOW TABLES IN {database}").collect() if not row.isTemporary]


class Databases:
    """Makes scratch databases, and notes whether they are gone afterwards and the most files that held changes, one per slice."""

    def __init__(self):
        self.dropped, self.most = 0, 0

    @contextmanager
    def __call__(self, spark):
        with tables.scratch_database(spark) as name:
            yield name
            assert tables_in(spark, name) == ["arrived", "changes"]
            folder = spark.sql(f"DESCRIBE DATABASE {name}").where("info_name = 'Location'").first().info_value
            self.most = max(self.most, len({file.split("-c0")[0].split("-", 2)[2] for file in spark.table(f"{name}.changes").inputFiles()}))
        self.dropped += not spark.catalog.databaseExists(name.strip("`")) and not Path(folder.removeprefix("file:")).exists()


def test_deliveries_and_taken_messages_are_deleted(spark, bronze_rows, tmp_path, monkeypatch):
    kinds, left = ["T", "N", "A"], []
    rows = [request(str(k), f"01/0{1 + k % 9}/2015 01:00:00 AM", problem_detail=kinds[k % 3]) for k in range(30)]
    monkeypatch.setattr(queries, "raw", lambda *_: bronze_rows(*rows))
    monkeypatch.setattr(queries, "scratch_path", lambda _, label: str(tmp_path / label))
    follow = incremental.follow

    def followed(messages, store, **options):
        names = [name for row in spark.sql("SHOW DATABASES LIKE 'scratch_*'").collect() for name in tables_in(spark, row.namespace)]
        follow(messages, store, **options)
        left.append((names, {file.name for file in Path(store.path("messages")).glob("part-*")}))

    monkeypatch.setattr(queries.incremental, "follow", followed)
    store = queries.merged(spark, "made up")
    assert values(store.read("request_cleaned"), "request_id") == [(k,) for k in range(30)]
    assert [names for names, _ in left] == [["deliveries"], ["deliveries"], []]
    first = left[0][1]
    end = time.time() + 20
    while first & {file.name for file in (tmp_path / "merged" / "messages").glob("part-*")} and time.time() < end:
        time.sleep(0.2)
    assert first and not first & {file.name for file in (tmp_path / "merged" / "messages").glob("part-*")}
    assert left[2][1] - left[1][1], "messages of the last run stay"
