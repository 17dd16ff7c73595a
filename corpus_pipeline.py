"""A training corpus out of raw documents: identify languages, drop near-duplicates, mask secrets, mix sources, tokenise."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.llm import bpe, langid, mixing, secrets, simhash
from civiclake.llm.common import row_hash, small_batches, stored, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language models accept. Null texts and texts without letters go."""
    small_batches(spark)
    columns = "_lang_pred", "_score", "_accepted"
    return langid.identify(docs, langid.fit(docs), columns=columns).where("_accepted").drop(*columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest ``doc_id`` (nulls last; then by its values)."""
    if "_row" in docs.columns:
        raise ValueError("column _row exists")
    small_batches(spark)
    rows = stored(docs.withColumns({"_row": F.monotonically_increasing_id(), "_hash": row_hash(docs)}), "dedup")
    groups = simhash.near_duplicates(rows.select("_row", "text"), "_row", "text")
    of = groups.select(F.col("doc_id").alias("_row"), F.col("component_id").alias("_group"))
    ranked = rows.select("_row", "doc_id", "_hash").join(of, "_row")
    first = F.min(F.struct(F.isnull("doc_id").alias("missing"), "doc_id", "_hash", "_row")).alias("first")
    kept = ranked.groupBy("_group").agg(first).select(F.col("first._row").alias("_row"))
    return rows.join(kept, "_row", "left_semi").select(*docs.columns)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked and ``n_chars`` counted anew."""
    small_batches(spark)
    masked = secrets.redact(docs, secrets.fit(docs))
    return masked.withColumn("n_chars", F.char_length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, as often as it takes them, with ``n_chars`` counted anew."""
    return mixing.sample(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document of the mix: number of tokens, SHA-256 of the ids and of what they decode to."""
    small_batches(spark)
    return bpe.result(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("secret_scans", secret_scans),
    ("mix_sources", mix_sources),
    ("bpe_encoding", bpe_encoding),
]

#: Trained models and hashes that SQL lacks decide what stays.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs
