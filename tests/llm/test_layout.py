"""Stages whose rows must not depend on how their input is laid out."""

import pytest

import corpus_pipeline
from civiclake.llm import mixing


def contents(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("stage", [corpus_pipeline.near_dedup, corpus_pipeline.mix_sources])
def test_stage_does_not_depend_on_partitions(spark, stage):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id is not null")
    docs = docs.union(docs.selectExpr("doc_id", "concat(text, ' more')", "lang", "source", "n_chars"))
    found = [contents(stage(spark, docs.repartition(n, "n_chars"), "")) for n in (1, 2, 5)]
    assert found[0] == found[1] == found[2] and found[0]


def test_a_column_that_the_stages_use_is_refused(spark):
    docs = spark.createDataFrame([(1, "a b", "s", 2)], "doc_id long, text string, source string, _row int")
    for step in (lambda: mixing.sample(docs), lambda: corpus_pipeline.near_dedup(spark, docs, "")):
        with pytest.raises(ValueError, match="_row"):
            step()
