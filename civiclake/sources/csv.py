"""All-text CSV with a header, doubled quotes, and line breaks inside quotes.

Every file is split, line breaks inside quotes or not, and one rule says what a record is, whatever the size of a file or of its
parts. Only ``\\n`` ends a line. At a line's start a reader is outside or inside quotes. A first pass reads each part both ways
and gives one small row for it: in which state it ends for either start, and the pieces of records that cross its borders. From
these rows every part learns how it starts, and the records across borders are put together; no other line is moved. The pass that
returns rows then cuts each part into records where it is scanned. A record is a line that starts outside quotes and isn't empty,
with those after it that start inside.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civiclake.session import scratch_path

_FORMAT = {"header": "true", "quote": '"', "escape": '"', "encoding": "UTF-8"}
#: Characters of a piece of a record that a first pass keeps while it does not know how its part starts, and of any record.
BORDER, MOST = 1 << 20, 1 << 27
#: Bytes that a task reads, where files are split into smaller parts.
TASK = 1 << 24
#: Rows in a compressed file.
FILE_ROWS = 200_000

# A quote opens a quoted field only at the field's start, a doubled one is text; after the closing quote, text up to the next comma
# belongs to the field. A line that is no list of whole fields ends inside quotes.
_FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"(?:[^",][^,]*+)?+|(?:[^",][^,]*+)?+)'
_WHOLE = re.compile(f"{_FIELD}(?:,{_FIELD})*+", re.DOTALL)


def _ends_inside(line: str, inside: bool) -> bool:
    return _WHOLE.fullmatch('"' + line if inside else line) is None


def _is_record(line: str) -> bool:
    return line not in ("", "\r")


class _Reader:
    """Reads a part's lines from one state: its records, and what of a record lies across its borders."""

    def __init__(self, inside: bool, limit: int, where: str):
        self.inside, self.limit, self.where = inside, limit, where
        self.tail: str | None = None  # of a record that began before the part
        self.open: list[str] | None = [] if inside else None  # of a record that is not over; None if there is none
        self.size, self.lost, self.at_start = 0, False, inside

    def _keep(self, lines: list[str]) -> None:
        self.size += sum(map(len, lines)) + len(lines)
        if self.size > self.limit:
            if self.limit == MOST:
                raise ValueError(f"{self.where}: a quote opens a record of over {MOST} characters")
            self.lost, self.open = True, []
        if not self.lost:
            self.open += lines

    def plain(self, lines: list[str]) -> list[str]:
        """Lines without a quote, which change no state; returns the records among them."""
        if self.inside:
            self._keep(lines)
            return []
        return [line for line in lines if _is_record(line)]

    def quoted(self, line: str) -> str | None:
        """A line with quotes; returns the record that it ends."""
        before, self.inside = self.inside, _ends_inside(line, self.inside)
        if not before and not self.inside:
            return line
        if not before:
            self.open, self.size, self.lost = [], 0, False
        self._keep([line])
        if self.inside:
            return None
        record = None if self.lost else "\n".join(self.open)
        self.open = None
        if self.at_start:
            self.at_start, self.tail, self.tail_lost = False, record, self.lost
            return None
        return record

    def border(self) -> tuple:
        """Whether it ends inside; the tail, and whether the record ends there; the text that stays open; whether text is missing."""
        text = "\n".join(self.open) if self.open is not None and not self.lost else None
        if self.at_start:
            return self.inside, text, False, None, self.lost
        tail_lost = getattr(self, "tail_lost", False)
        return self.inside, self.tail, self.tail is not None or tail_lost, text, tail_lost or self.inside and self.lost


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bool, list[str], bool]]:
    """Lines in order, in runs of one part that have no quote, or alone with one: (part, start given, lines, has quotes)."""
    for batch in batches:
        files, parts, states = (batch.column(k) for k in (0, 1, 2))
        values, quotes = batch.column(3), pc.match_substring(batch.column(3), '"')
        keys = list(zip(files.to_pylist(), parts.to_pylist()))
        marks, given = quotes.to_pylist(), states.to_pylist()
        lines, low = values.to_pylist(), 0
        while low < len(lines):
            high = low + 1
            if not marks[low]:
                while high < len(lines) and not marks[high] and keys[high] == keys[low]:
                    high += 1
            yield keys[low], given[low], lines[low:high], marks[low]
            low = high


_STATE = "inside boolean, tail string, closed boolean, open string, lost boolean"
_PART_ROW = f"file string, part long, header string, outside struct<{_STATE}>, within struct<{_STATE}>"


def _part_rows(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """One row per part: its first record if it is a file's first part, and how it ends from either start (or the one given)."""
    names = ["inside", "tail", "closed", "open", "lost"]
    kind = pa.struct([(name, pa.string() if name in ("tail", "open") else pa.bool_()) for name in names])
    schema = pa.schema([("file", pa.string()), ("part", pa.int64()), ("header", pa.string()), ("outside", kind), ("within", kind)])
    at, readers, header = None, [], None

    def row() -> pa.RecordBatch:
        ends = [None if reader is None else dict(zip(names, reader.border())) for reader in readers]
        return pa.RecordBatch.from_pylist(
            [{"file": at[0], "part": at[1], "header": header, "outside": ends[0], "within": ends[1]}], schema
        )

    for key, given, lines, has_quotes in _runs(batches):
        if key != at:
            if at:
                yield row()
            at, header, where = key, None, f"{key[0]} from byte {key[1]}"
            readers = [_Reader(inside, limit, where) if given in (None, int(inside)) else None for inside in (False, True)]
        for reader in readers:
            if reader is not None:
                found = [reader.quoted(lines[0])] if has_quotes else reader.plain(lines)
                if key[1] == 0 and header is None and reader is readers[0]:
                    header = next((record for record in found if record is not None), None)
    if at:
        yield row()


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records that lie within a part, without the file's first."""
    at, reader, skip, held = None, None, False, []
    for key, given, lines, has_quotes in _runs(batches):
        if key != at:
            if given is None:
                raise ValueError(f"{key[0]} has changed, or is split otherwise, since its parts were read")
            at, reader, skip = key, _Reader(bool(given), MOST, f"{key[0]} from byte {key[1]}"), key[1] == 0
        found = [reader.quoted(lines[0])] if has_quotes else reader.plain(lines)
        for record in found:
            if record is not None:
                if not skip:
                    held.append(record.removesuffix("\r"))
                skip = False
        if len(held) >= 5000:
            yield pa.RecordBatch.from_pydict({"record": pa.array(held, pa.string())})
            held = []
    if held:
        yield pa.RecordBatch.from_pydict({"record": pa.array(held, pa.string())})


def _tasks(spark: SparkSession, path: str | list[str]) -> int:
    """How many tasks read the files: some for every core, and as many as have ``TASK`` bytes each."""
    size = spark.read.format("binaryFile").load(path).agg(F.sum("length").alias("size")).first()["size"] or 0
    return max(4 * spark.sparkContext.defaultParallelism, -(-size // TASK))


def _lines(spark: SparkSession, path: str | list[str], tasks: int, starts: DataFrame | None = None) -> DataFrame:
    """All lines with their file, their part (where it starts) and, if known, the state it starts in (0 outside, 1 inside). A task
    reads its parts one after another, each from its first line to its last."""
    text = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("part"), "value"
    ).coalesce(tasks)
    if starts is None:
        return text.select("file", "part", F.lit(None).cast("int").alias("start"), "value")
    # one short row per part of the input, and a part is as large as spark.sql.files.maxPartitionBytes says
    return text.join(F.broadcast(starts), ["file", "part"], "left").select("file", "part", "start", "value")


def _kept(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _read_parts(lines: DataFrame, limit: int) -> DataFrame:
    return lines.mapInArrow(lambda batches: _part_rows(batches, limit), _PART_ROW)


def _with_starts(parts: DataFrame) -> DataFrame:
    """Adds ``start``, the state each part starts in: a part sets the state whatever it was, keeps it, or turns it, so the last that
    set it counts and the turns since."""
    before = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    outside, within = F.col("outside.inside"), F.col("within.inside")
    turns = F.coalesce(F.sum(F.when(outside & ~within, 1).otherwise(0)).over(before), F.lit(0))
    counted = parts.withColumn("_turns", turns)
    sets = F.when(outside == within, F.struct(outside.cast("int").alias("state"), F.col("_turns").alias("turns")))
    last = F.last(sets, ignorenulls=True).over(before)
    start = F.coalesce(last["state"], F.lit(0)) + F.col("_turns") - F.coalesce(last["turns"], F.lit(0))
    return counted.withColumn("start", (start % 2).cast("int")).drop("_turns")


def _crossing(parts: DataFrame) -> DataFrame:
    """``record``: each record that lies across borders of parts, put together from its pieces."""
    known = parts.withColumn("of", F.when(F.col("start") == 1, F.col("within")).otherwise(F.col("outside")))
    pieces = known.select("file", "part", F.inline(F.array(
        F.struct(F.lit(0).alias("place"), F.col("of.tail").alias("text"), F.lit(False).alias("begins")),
        F.struct(F.lit(1).alias("place"), F.col("of.open").alias("text"), F.lit(True).alias("begins")),
    ))).where("text is not null")
    order = Window.partitionBy("file").orderBy("part", "place").rowsBetween(Window.unboundedPreceding, 0)
    owned = pieces.withColumn("owner", F.sum(F.col("begins").cast("int")).over(order))
    ordered = F.array_sort(F.collect_list(F.struct("part", "place", "text")))
    size = F.sum(F.char_length("text"))
    told = F.concat(F.col("file"), F.lit(f" from byte "), F.min("part").cast("string"), F.lit(f": a quote opens a record of over {MOST} characters"))
    text = F.when(size > MOST, F.raise_error(told)).otherwise(F.array_join(F.transform(ordered, lambda piece: piece["text"]), "\n"))
    return owned.groupBy("file", "owner").agg(F.regexp_replace(text, "\r$", "").alias("record")).select("record")


def _missing(known: DataFrame) -> Column:
    return F.when(F.col("start") == 1, F.col("within.lost")).otherwise(F.col("outside.lost"))


def records(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, list[str]]:
    """``record``, the text of each record of the files but their first; and these first ones: the least and the greatest of them.

    Empty lines outside quotes are no records; a line of blanks is one. A carriage return at a record's end goes. A header must
    end within its file's first part.
    """
    tasks = _tasks(spark, path)
    parts = _kept(_with_starts(_read_parts(_lines(spark, path, tasks), BORDER)), "csv-parts")
    starts = parts.select("file", "part", "start")
    first, header = F.col("part") == 0, F.regexp_replace("header", "\r$", "")
    of_file = parts.withColumn("first_header", F.first("header").over(Window.partitionBy("file").orderBy("part")))
    headless = F.when(first, F.col("header").isNull() & F.col("outside.inside")).otherwise(F.col("first_header").isNull())
    found = of_file.agg(
        F.min(header).alias("least"), F.max(header).alias("greatest"), F.bool_or(headless).alias("headless"),
        F.collect_set(F.when(_missing(parts), F.col("file"))).alias("again"),
    ).first()
    if found["headless"]:
        raise ValueError("a file has no whole header in its first part")
    again, whole = found["again"], parts
    if again:  # pieces longer than BORDER: these files' parts once more, from the state that is known by now
        longer = _read_parts(_lines(spark, path, tasks, starts).where(F.col("file").isin(again)), MOST).join(starts, ["file", "part"])
        whole = parts.where(~F.col("file").isin(again)).unionByName(_kept(longer, "csv-long-parts"))
    within = _lines(spark, path, tasks, starts).mapInArrow(_records, "record string")
    return within.unionByName(_crossing(whole)), sorted({x for x in (found["least"], found["greatest"]) if x is not None})


def read_csv_text(spark: SparkSession, path: str | list[str], names: list[str]) -> DataFrame:
    """Every field as text under the given names, by position. Empty fields are NULL.

    Header names may be blank or repeat. A header with another number of columns is an error, and so is a file whose header
    differs from another's. No files' rows depend on how the files are split; ``spark.sql.files.maxPartitionBytes`` says how, and
    must not change before the rows are read.
    """
    found, headers = records(spark, path)
    if len(headers) > 1:
        raise ValueError("the files differ in their header")
    for header in headers:
        columns = next(csv.reader([header.removeprefix("\ufeff")], strict=False))
        if len(columns) != len(names):
            raise ValueError(f"the file has {len(columns)} columns, {len(names)} were expected")
    options = {**_FORMAT, "multiLine": "true", "lineSep": "\n", "maxCharsPerColumn": "-1"}
    schema = ", ".join(f"`c{k}` string" for k in range(len(names)))
    # a generator, so that no later filter parses a record once more
    parsed = found.select(F.explode(F.array(F.from_csv("record", F.lit(schema), options))).alias("row"))
    return parsed.select(*[F.col(f"row.c{k}").alias(name) for k, name in enumerate(names)])


def write_csv_text(df: DataFrame, path: str, mode: str = "errorifexists", compressed: bool = False) -> None:
    """CSV that ``read_csv_text`` reads back unchanged (an empty text comes back as NULL). ``compressed`` writes gzip files of at most
    ``FILE_ROWS`` rows, since such a file is read as one part."""
    gzip = {"compression": "gzip", "maxRecordsPerFile": str(FILE_ROWS)} if compressed else {}
    df.write.mode(mode).options(
        **_FORMAT, ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false", emptyValue="", **gzip
    ).csv(path)
