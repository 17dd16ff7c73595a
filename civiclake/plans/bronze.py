"""Bronze: all-text rows from files or messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from civiclake.rules import RAW_COLUMNS
from civiclake.sources.csv import read_csv_text
from civiclake.sources.messages import decode_messages, matched_fields, read_kafka
from civiclake.sources.tables import Store, slices
from civiclake.streaming.ingest import append_available

BATCH, STREAM = "request_raw", "request_raw_stream"


def load(spark, source: str, **options) -> DataFrame:
    """Raw rows. ``source`` is "csv" (``path``), "messages" (``messages``, ``fields``) or "kafka"
    (``servers``, ``topic``, ``fields``, ``options``). Without ``fields``, the topic's fields are matched by name."""
    if source == "csv":
        return read_csv_text(spark, options["path"], RAW_COLUMNS)
    if source == "messages":
        return decode_messages(options["messages"], RAW_COLUMNS, options.get("fields"))
    if source == "kafka":
        messages = read_kafka(spark, options["servers"], options["topic"], **options.get("options", {}))
        fields = options.get("fields") or matched_fields(messages, RAW_COLUMNS)
        return decode_messages(messages, RAW_COLUMNS, fields)
    raise ValueError(f"unknown source {source!r}: use csv, messages or kafka")


def append(raw: DataFrame, store: Store, by: str | None = None) -> DataFrame:
    """Append raw rows to the bronze table. No rows at all is an error; they are counted while they are written, and what was
    written counts only after that. With ``by``, for rows that are shuffled on the way, they are worked out in slices by that column."""
    count, draft = 0, store.draft()
    for rows in slices(raw, by) if by else [raw]:
        written = Observation()
        draft.write(rows.observe(written, F.count(F.lit(1)).alias("rows")), BATCH, "append")
        count += written.get["rows"]
    if count == 0:
        raise ValueError("the source has no rows")
    return draft.publish().read(BATCH)


def append_new(messages: DataFrame, store: Store, fields: dict[str, str] | None = None) -> DataFrame:
    """Take over the messages of a stream that have arrived since the last run; each one once.

    They go to a table of their own: a stream's log decides which of the folder's files count, so batch files must not
    lie among them.
    """
    append_available(
        decode_messages(messages, RAW_COLUMNS, fields), store.path(STREAM), f"{store.root}/checkpoints/{STREAM}"
    )
    return store.read(STREAM)


def rows(store: Store) -> DataFrame:
    """All bronze rows, from batches and streams. A load that failed for want of rows leaves none."""
    present = [store.read(table) for table in (BATCH, STREAM) if store.exists(table)]
    present = [table for table in present if not table.isEmpty()]
    if not present:
        raise ValueError("no bronze rows have been loaded yet")
    return present[0] if len(present) == 1 else present[0].unionAll(present[1])
