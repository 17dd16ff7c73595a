"""Parquet tables: a store of named tables in a folder, and catalog tables."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from civiclake.functions.labels import all_true
from civiclake.operators.dedupe import keep_first
from civiclake.operators.lookups import data_bytes
from civiclake.schemas import TABLES
from civiclake.session import scratch_path
from civiclake.sources import manifest

#: Of a table's rows in memory, as much as a bucket may hold.
BUCKET_BYTES = 64 << 20
#: Bytes of input files whose rows are shuffled at a time, where a table is written slice by slice, and the most slices.
SLICE_BYTES, MOST_SLICES = 3 << 29, 8
#: How tables and intermediate ones are written.
COMPACT = {"compression": "zstd"}


def input_bytes(df: DataFrame) -> int:
    """Size of the files that the rows are made of; 0 if there are none."""
    files = [re.sub(r"([\\\[\]{}*?])", r"\\\1", unquote(file)) for file in df.inputFiles()]
    if not files:
        return 0
    listed = df.sparkSession.read.format("binaryFile").option("recursiveFileLookup", "true").load(files)
    return listed.agg(F.sum("length").alias("size")).first()["size"] or 0


def slices(df: DataFrame, key: str, size: int | None = None) -> list[DataFrame]:
    """The rows in slices by a hash of ``key``, NULL like any value: as many as ``SLICE_BYTES`` fit into the input files, or ``size``.

    Steps that shuffle rows by the key, or by what it is made of, do so for one slice after another, and what one has shuffled is
    gone before the next begins, so the disk holds a slice's shuffle files and not the table's. Each slice reads the input anew,
    hence never more than ``MOST_SLICES``.
    """
    count = min(-(-(input_bytes(df) if size is None else size) // SLICE_BYTES), MOST_SLICES)
    if count < 2:
        return [df]
    place = F.pmod(F.xxhash64(key), F.lit(count))
    return [df.where(place == number) for number in range(count)]


@dataclass(frozen=True)
class Store:
    """Named tables as Parquet files below ``root``, which all executors must see.

    A table is a list of folders, its parts. No folder is ever written twice: a write makes a new one, and a manifest, one small
    file that appears as a whole, says which folders count from then on. So a reader sees all of a write or nothing of it, and a
    write that dies leaves the tables as they were. A store without ``parts`` follows the newest manifest at every read; ``pinned``
    gives one that stays with what it has seen. One writer at a time; a writer that was overtaken is refused. Folders that no
    manifest names any more stay; give them an expiry longer than any reader's work.
    """

    spark: SparkSession
    root: str
    parts: dict[str, dict[str, str]] | None = None

    def path(self, table: str) -> str:
        """The folder of a table that has no manifest, such as one a stream keeps its own log in."""
        return f"{self.root.rstrip('/')}/{table}"

    def tables(self) -> dict[str, dict[str, str]]:
        """Of each table in the manifest: its parts' names and folders."""
        return manifest.newest(self.spark, self.root)[1] if self.parts is None else self.parts

    def pinned(self) -> Store:
        return Store(self.spark, self.root, self.tables())

    def draft(self) -> Draft:
        """A store to write several tables in; others see them when ``publish`` is called, all at once."""
        version, parts = manifest.newest(self.spark, self.root)
        return Draft(self.spark, self.root, {name: dict(folders) for name, folders in parts.items()}, version)

    def write(self, df: DataFrame, table: str, mode: str = "overwrite", by: str | None = None) -> DataFrame:
        """Write the table, or append to it, and return it as a scan of what was written, so later steps do not work it out again.
        With ``by`` it is worked out in slices by that column."""
        draft = self.draft()
        for number, rows in enumerate(slices(df, by) if by else [df]):
            draft.write(rows, table, "append" if number else mode)
        return draft.publish().read(table)

    def write_declared(self, df: DataFrame, table: str, required: list[str], key: list[str], mode: str = "overwrite") -> DataFrame:
        """Write the table only if every required column has a value in all rows, new or held, and no key comes twice.

        NULLs are counted while the rows are written; keys, NULL like any value, are counted in what was written. A refused write
        raises and leaves the table as it was.
        """
        counted, draft = Observation(), self.draft()
        missing = [F.count_if(F.col(name).isNull()).alias(name) for name in required]
        written = draft.write(df.observe(counted, F.count(F.lit(1)).alias("_rows"), *missing), table, mode)
        empty = sorted(name for name in required if counted.get[name])
        twice = written.groupBy(*key).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1")
        if empty or not twice.isEmpty():
            raise ValueError(f"{table}: no value in required columns {empty}" if empty else f"{table}: {key} comes twice")
        return draft.publish().read(table)

    def read(self, table: str, only: list[str] | None = None) -> DataFrame:
        """The table, or the parts of it named in ``only``, as far as it has them."""
        reader, schema = self.spark.read, TABLES.get(table)
        if schema:
            reader = reader.schema(schema)
        folders = self.tables().get(table)
        if folders is None:
            return reader.parquet(self.path(table))
        wanted = folders if only is None else set(only)
        chosen = [folder for part, folder in folders.items() if part in wanted]
        if not chosen:
            return self.spark.createDataFrame([], schema)
        return reader.parquet(*[self.path(folder) for folder in chosen])

    def exists(self, table: str) -> bool:
        if table in self.tables():
            return True
        try:
            self.spark.read.text(self.path(table))
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return False
            raise
        return True

    def insert_absent(self, rows: DataFrame, table: str, keys: list[str]) -> DataFrame:
        """Append the rows whose key the table does not hold yet; running it again changes nothing. NULL is a key like any other.

        Of several new rows with one key the first by the other columns is taken.
        """
        others = [name for name in rows.columns if name not in keys]
        new = keep_first(rows, keys, others[:1], others) if others else rows.distinct()
        if self.exists(table):
            held = self.read(table).select(*[F.col(key).alias(f"_held_{key}") for key in keys])
            same = all_true([F.col(key).eqNullSafe(F.col(f"_held_{key}")) for key in keys])
            new = new.join(held, same, "left_anti").select(*rows.columns)
        return self.write(new, table, "append")


@dataclass(frozen=True)
class Draft(Store):
    """The tables of the next manifest. It reads what it has written itself, and the rest as it was when it began."""

    version: int = 0
    changed: set[str] = field(default_factory=set)

    def folder(self, table: str) -> str:
        return f"data/{table}/{uuid.uuid4().hex}"

    def write(self, df: DataFrame, table: str, mode: str = "overwrite", part: str | None = None) -> DataFrame:
        """A new folder of the table, as its only part or (``append``) one more, named ``part`` or like the folder."""
        folder = self.folder(table)
        df.write.options(**COMPACT).parquet(self.path(folder))
        held = self.parts.get(table, {}) if mode == "append" else {}
        self.parts[table] = {**held, part or folder: folder}
        self.changed.add(table)
        return self.read(table)

    def replace_parts(self, df: DataFrame, table: str, by: str, parts: list[str]) -> list[str]:
        """Rows of the named parts, the values of the whole-number column ``by``, in place of what these parts held; returns the
        names of those that have rows. They are asked of ``df``, which should be a scan, so that no folder has to be listed."""
        folder, gone = self.folder(table), set(parts)
        df.write.options(**COMPACT).partitionBy(by).parquet(self.path(folder))
        written = [str(row[by]) for row in df.select(by).distinct().collect()]
        held = {part: place for part, place in self.parts.get(table, {}).items() if part not in gone}
        self.parts[table] = {**held, **{part: f"{folder}/{by}={part}" for part in written}}
        self.changed.add(table)
        return written

    def mark(self, table: str, part: str) -> None:
        """A part without rows, such as a batch that has been taken over."""
        self.parts.setdefault(table, {})[part] = ""
        self.changed.add(table)

    def publish(self) -> Store:
        """Switch all readers to what was written here. Refused if another writer has changed one of the same tables since."""
        version, current = manifest.newest(self.spark, self.root)
        if version != self.version:
            before = manifest.at(self.spark, self.root, self.version)
            lost = sorted(name for name in self.changed if current.get(name) != before.get(name))
            if lost:
                raise RuntimeError(f"another writer has changed {lost}")
            current.update({name: self.parts[name] for name in self.changed})
        else:
            current = self.parts
        manifest.write(self.spark, self.root, version + 1, current)
        return Store(self.spark, self.root, current)


def create_tables(spark: SparkSession, database: str, tables: dict[str, StructType] | None = None) -> None:
    """The declared tables, empty, where the catalog does not have them yet."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name, schema in (tables or TABLES).items():
        columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({columns}) USING parquet")


@contextmanager
def scratch_database(spark: SparkSession) -> Iterator[str]:
    """The name of a database for intermediate tables that nothing reads afterwards; it is dropped with them at the end."""
    name = f"scratch_{uuid.uuid4().hex}"
    place = scratch_path(spark, name).replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE DATABASE `{name}` LOCATION '{place}'")
    try:
        yield f"`{name}`"
    finally:
        spark.sql(f"DROP DATABASE `{name}` CASCADE")


def save_as_table(df: DataFrame, name: str, mode: str = "overwrite") -> DataFrame:
    """Write a query's result as a catalog table and return the table."""
    df.write.mode(mode).options(**COMPACT).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def buckets_for(tables: list[DataFrame], least: int = 1) -> int:
    """Into how many buckets tables of that size go, so that no task has to hold and sort much of one: a power of two from ``least``
    on, and no more than ``BUCKET_BYTES`` of a table's rows in a bucket, unless a key has more than that."""
    wanted, buckets = max(map(data_bytes, tables)) / BUCKET_BYTES, least
    while buckets < wanted:
        buckets *= 2
    return buckets


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """A catalog table whose rows lie in ``buckets`` files by a hash of ``key``, sorted by it, and return the table.

    Tables with as many buckets by their keys are joined and grouped by them without being moved. ``path`` puts the files there.
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
    writer = writer.options(**COMPACT)
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)
