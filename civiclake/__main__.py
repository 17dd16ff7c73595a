"""The steps as jobs: ``spark-submit`` this file, or ``python -m civiclake``, with a step and its options."""

from __future__ import annotations

import argparse
import sys

from civiclake.plans import bronze, checks, incremental, run
from civiclake.plans.views import register_views
from civiclake.rules import RAW_COLUMNS
from civiclake.schemas import MESSAGE
from civiclake.session import build_session
from civiclake.sources.csv import read_csv_text
from civiclake.sources.jdbc import export
from civiclake.sources.messages import (
    encode_messages, header_fields, matched_fields, ordered_fields, read_kafka, stream_kafka, write_kafka,
)
from civiclake.sources.tables import Store
from civiclake.streaming.ingest import stream_message_files

STEPS = ["publish", "ingest", "merge", "bronze", "silver", "star", "rollups", "check", "all", "sql", "export"]


def _options() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="civiclake", description=__doc__)
    parser.add_argument("step", choices=STEPS)
    parser.add_argument("--store", required=True, help="folder of the tables, visible to all executors")
    parser.add_argument("--csv", help="CSV file or folder to read")
    parser.add_argument("--messages", help="folder of message files to write or read")
    parser.add_argument("--kafka", help="bootstrap servers, instead of a message folder")
    parser.add_argument("--topic", default="requests_raw")
    parser.add_argument("--fields", choices=["header", "order"], default="header",
                        help="messages name their fields like 'Unique Key', or have all fields in file order")
    parser.add_argument("--field", action="append", default=[], metavar="COLUMN=FIELD",
                        help="the field of a column that is named otherwise, with --fields header")
    parser.add_argument("--jdbc-url", help="database to export silver and gold to")
    parser.add_argument("--jdbc-property", action="append", default=[], metavar="NAME=VALUE", help="such as driver")
    parser.add_argument("--query", help="SQL text over the stored tables, for the step sql")
    parser.add_argument("--output", help="folder the step sql writes its whole result to, as Parquet; else it is printed whole")
    parser.add_argument("--kafka-option", action="append", default=[], metavar="NAME=VALUE",
                        help="such as minPartitions, for reading a topic in more tasks than it has partitions")
    parser.add_argument("--connections", type=int, default=16, help="database connections of the step export")
    return parser


def publish(spark, given) -> None:
    rows = read_csv_text(spark, given.csv, RAW_COLUMNS)
    messages = encode_messages(rows, "unique_key", header_fields(RAW_COLUMNS))
    if given.kafka:
        write_kafka(messages, given.kafka, given.topic)
    else:
        messages.write.mode("append").parquet(given.messages)


def _pairs(given: list[str]) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in given)


def _fields(spark, given) -> dict[str, str]:
    if given.kafka:
        messages = read_kafka(spark, given.kafka, given.topic, **_pairs(given.kafka_option))
    else:
        messages = spark.read.schema(MESSAGE).parquet(given.messages)
    if given.fields == "header":
        return matched_fields(messages, RAW_COLUMNS, _pairs(given.field))
    return ordered_fields(messages, RAW_COLUMNS)


def ingest(store: Store, given) -> None:
    if given.kafka:
        stream = stream_kafka(store.spark, given.kafka, given.topic, **_pairs(given.kafka_option))
    else:
        stream = stream_message_files(store.spark, given.messages)
    bronze.append_new(stream, store, _fields(store.spark, given))


def merge(store: Store, given) -> None:
    """Silver and the roll-ups' sums, from the messages since the last run alone."""
    if given.kafka:
        stream = stream_kafka(store.spark, given.kafka, given.topic, **_pairs(given.kafka_option))
    else:
        stream = stream_message_files(store.spark, given.messages)
    incremental.follow(stream, store, _fields(store.spark, given))


def load(store: Store, given) -> None:
    spark = store.spark
    if given.kafka:
        fields = _fields(spark, given)
        options = _pairs(given.kafka_option)
        raw = bronze.load(spark, "kafka", servers=given.kafka, topic=given.topic, fields=fields, options=options)
    elif given.messages:
        messages = spark.read.schema(MESSAGE).parquet(given.messages)
        raw = bronze.load(spark, "messages", messages=messages, fields=_fields(spark, given))
    else:
        raw = bronze.load(spark, "csv", path=given.csv)
    bronze.append(raw, store)


def check(store: Store) -> int:
    """Print the contract's report; 1 if a rule of severity error does not pass."""
    names = ("requests", "date", "agency", "location", "complaint", "status")
    report = checks.contract_report({name: store.read(name) for name in names}).collect()
    for row in report:
        verdict = "passed" if row.passed else f"FAILED ({row.severity})"
        print(f"{row.metric}: {row.value} {row.comparison} {row.threshold} {verdict}")
    return int(any(row.severity == "error" and not row.passed for row in report))


def main(arguments: list[str], spark=None) -> int:
    given = _options().parse_args(arguments)
    spark = spark or build_session()
    store = Store(spark, given.store)
    if given.step == "publish":
        publish(spark, given)
    if given.step == "ingest":
        ingest(store, given)
    if given.step == "merge":
        merge(store, given)
    if given.step in ("bronze", "all"):
        load(store, given)
    if given.step in ("silver", "all"):
        run.build_silver(store, bronze.rows(store))
    if given.step in ("star", "all"):
        run.build_star(store)
    if given.step in ("rollups", "all"):
        run.build_rollups(store)
    if given.step == "sql":
        register_views(store)
        result = spark.sql(given.query)
        if given.output:
            result.write.parquet(given.output)
        else:
            print(*result.columns, sep="\t")
            for row in result.toLocalIterator():  # all rows, a partition at a time
                print(*row, sep="\t")
    if given.step == "export":
        export(store, given.jdbc_url, _pairs(given.jdbc_property), connections=given.connections)
    return check(store) if given.step in ("check", "all") else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
