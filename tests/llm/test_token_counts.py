import random
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from civiclake.llm import token_counts

PIECES = ["ab", "c ", "  ", "\n", " d", "'s", "12", " é", "!", "x" * 9, " ", "中", " ", "\x1c", "😀"]


@pytest.fixture(scope="module")
def encoding():
    return token_counts.encoder(public_tokenizers.path(token_counts.TOKENIZER))


def random_text(rng, most):
    return "".join(rng.choice(PIECES) for _ in range(rng.randrange(most)))


def test_edits_keep_the_whole_texts_count(encoding, monkeypatch):
    monkeypatch.setattr(token_counts, "LEAF", 12)
    rng = random.Random(5)
    for _ in range(300):
        text = random_text(rng, 80)
        tree = token_counts.build(text, encoding)
        for _ in range(3):
            text, tree, _ = token_counts.edit(
                text, tree, rng.randrange(len(text) + 3), rng.randrange(9), random_text(rng, 6), encoding
            )
            leaves = tree.sums[tree.width:tree.width + len(tree.lengths)]
            assert tree.tokens == len(encoding.encode_ordinary(text)) and sum(tree.lengths) == len(text)
            assert tree.sums == token_counts._summed(leaves)


def test_an_edit_reads_little_of_a_long_text(encoding):
    text = "some words of prose, " * 20_000
    tree = token_counts.build(text, encoding)
    changed, after, encoded = token_counts.edit(text, tree, 200_000, 5, "other", encoding)
    assert after.tokens == len(encoding.encode_ordinary(changed)) and encoded < 4 * token_counts.LEAF


def test_edge_documents(edge_docs, encoding):
    def count(text):
        return len(encoding.encode_ordinary(text))

    expected = Counter()
    for row in edge_docs.collect():
        text = row["text"] or ""
        middle = len(text) // 2
        edited = text[:middle] + text[:40] + text[middle + 20:]
        expected[(row["doc_id"], count(text), count(edited))] += 1
    found = token_counts.result(edge_docs).drop("n_encoded").collect()
    assert Counter(map(tuple, found)) == expected


def test_several_edits_and_nulls(spark, encoding):
    docs = spark.createDataFrame([(1, "one two three"), (2, "one two three"), (3, None)], "doc_id long, text string")
    edits = F.expr(
        "case doc_id when 1 then array(named_struct('start', 3, 'removed', 4, 'inserted', ' zwei'), null,"
        " named_struct('start', null, 'removed', null, 'inserted', 'null ')) when 3 then array(named_struct('start', 9,"
        " 'removed', 9, 'inserted', 'new text')) end"
    )
    found = {
        row["doc_id"]: (bytes(row["text"]).decode(), row["n_tokens"])
        for row in token_counts.edited(token_counts.trees(docs).withColumn("edits", edits), "edits").collect()
    }
    assert {k: text for k, (text, _) in found.items()} == {1: "null one zwei three", 2: "one two three", 3: "new text"}
    assert all(n == len(encoding.encode_ordinary(text)) for text, n in found.values())


def test_no_documents(no_docs):
    assert token_counts.result(no_docs).collect() == []
