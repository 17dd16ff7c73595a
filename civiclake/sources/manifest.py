"""Which folders make up the tables of a store: one numbered list after another, the newest counts.

Each list is written by one task as one file, which appears whole when the task commits. Its rows are the parts of tables, so
their number does not grow with the rows in them.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

Parts = dict[str, dict[str, str]]
_SCHEMA = "table string, part string, folder string"


def _path(root: str, version: int | None = None) -> str:
    return f"{root.rstrip('/')}/manifest" + ("" if version is None else f"/version={version}")


def newest(spark: SparkSession, root: str) -> tuple[int, Parts]:
    """The newest list's number, and its tables with their parts' folders; 0 and none before the first."""
    try:
        files = spark.read.schema(_SCHEMA).parquet(_path(root)).inputFiles()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        files = []
    version = max((int(file.rsplit("/version=", 1)[1].split("/")[0]) for file in files if "/version=" in file), default=0)
    return version, at(spark, root, version)


def at(spark: SparkSession, root: str, version: int) -> Parts:
    found: Parts = {}
    if version:
        for row in spark.read.schema(_SCHEMA).parquet(_path(root, version)).collect():
            parts = found.setdefault(row.table, {})
            if row.part is not None:
                parts[row.part] = row.folder
    return found


def write(spark: SparkSession, root: str, version: int, parts: Parts) -> None:
    """Add a list. What an earlier attempt at the same number left unfinished is replaced."""
    rows = [(table, part, folder) for table, folders in parts.items() for part, folder in folders.items()]
    rows += [(table, None, None) for table, folders in parts.items() if not folders]
    spark.createDataFrame(rows, _SCHEMA).coalesce(1).write.mode("overwrite").parquet(_path(root, version))
