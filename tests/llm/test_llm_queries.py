"""The registered queries next to their SQL, and the pipeline next to its stages' rules."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from civiclake.llm import langid, queries, simhash
from compare import connect, difference

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.all_oracles()))
def test_query_equals_its_sql(spark, name):
    assert difference(entry.queries()[name](spark, FOLDER), connect(FOLDER), entry.oracle_sql()[name]) is None


def test_all_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in queries.all_queries()}
    assert "pipeline" in entry.queries() and "pipeline" not in entry.oracle_sql()


@pytest.fixture(scope="module")
def stages(spark, edge_docs):
    """Each stage's input and output, over the edge documents."""
    docs, found = edge_docs, {}
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.stored(stage(spark, docs, FOLDER), name)
        found[name] = docs, out
        docs = out
    return found


def test_stages_keep_the_columns(stages, edge_docs):
    for name, (_, out) in list(stages.items())[:-1]:
        assert out.columns == edge_docs.columns, name


def test_language_stage(stages):
    docs, out = stages["language_id"]
    models = langid.fit(docs)
    kept = sorted(str(row) for row in docs.collect() if models.predict(row["text"])[2])
    assert sorted(map(str, out.collect())) == kept and kept


def test_near_duplicates_stage(stages):
    docs, out = stages["near_dedup"]
    groups = simhash.near_duplicates(docs).select("component_id").distinct().count()
    assert out.count() == groups
    assert all(row["component_id"] == row["doc_id"] for row in simhash.near_duplicates(out).collect() if row["doc_id"] is not None)


def test_mixing_and_encoding_stages(stages):
    docs, out = stages["mix_sources"]
    assert {row["doc_id"] for row in out.collect()} <= {row["doc_id"] for row in docs.collect()}
    assert stages["bpe_encoding"][1].count() == out.count()


def test_stages_on_an_empty_table(spark, no_docs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, FOLDER).collect() == []


def test_run(spark):
    found = corpus_pipeline.run(spark, FOLDER)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and found.count() > 0
