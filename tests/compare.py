"""Run registered queries next to their DuckDB form and compare whole results.

As a script: ``python tests/compare.py [folder] [query ...]``.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from civiclake.session import build_session  # noqa: E402

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    duck = duckdb.connect()
    for name in TABLES:
        duck.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return duck


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def _family(kind: str) -> str:
    kind = kind.lower()
    return {"varchar": "string", "integer": "int", "timestamp": "timestamp_ntz"}.get(kind, kind)


def difference(df, duck, sql: str) -> str | None:
    """None when columns, types and rows agree, else what differs."""
    names = sorted(df.columns)
    answer = duck.sql(sql)
    kinds = {name: _family(str(kind)) for name, kind in zip(answer.columns, answer.types)}
    if names != sorted(kinds):
        return f"columns {names} and {sorted(kinds)}"
    types = {field.name: field.dataType.simpleString() for field in df.schema.fields}
    wrong = {name: (types[name], kinds[name]) for name in names if types[name] != kinds[name]}
    if wrong:
        return f"types {wrong}"
    ours = Counter(tuple(_cell(row[name]) for name in names) for row in df.collect())
    quoted = ", ".join(f'"{name}"' for name in names)
    theirs = Counter(tuple(_cell(v) for v in row) for row in duck.sql(f"select {quoted} from ({sql})").fetchall())
    if ours != theirs:
        return f"{ours.total()} and {theirs.total()} rows; only ours {list((ours - theirs).items())[:3]};" \
               f" only SQL {list((theirs - ours).items())[:3]}"
    return None


def main(folder: str, names: list[str]) -> int:
    spark = build_session(
        "compare", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    duck, failed = connect(folder), 0
    queries, oracles = entry.queries(), entry.oracle_sql()
    for name in names or oracles:
        start = time.time()
        try:
            problem = difference(queries[name](spark, folder), duck, oracles[name])
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:800]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    arguments = sys.argv[1:]
    sys.exit(bool(main(arguments[0] if arguments else "/root/testdata/sf0.01", arguments[1:])))
