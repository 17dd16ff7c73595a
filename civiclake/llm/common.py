"""Small helpers of the operators in this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back, so that a lost executor cannot change or cost it."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows that Spark hands to Python at once. The default holds 10,000 whole texts several times over, in the JVM and in each worker.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python in small batches from now on. Results don't depend on it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def row_hash(docs: DataFrame) -> Column:
    """A hash of a whole row, so that equal rows are alike wherever they lie."""
    return F.xxhash64(*(F.col(name) for name in docs.columns))


def id_and_bytes(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``doc_id`` and the whole text as UTF-8 bytes; a null text is empty. All other columns are left out."""
    text = F.coalesce(F.col(text_column).cast("binary"), F.lit(b""))
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), text.alias("text"))


def digits(value: Column) -> Column:
    """A long's 64 bits as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))
