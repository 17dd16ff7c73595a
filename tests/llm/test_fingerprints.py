import hashlib

import pytest
from pyspark.sql import functions as F

from civiclake.llm import fingerprints


def shingles(text):
    found = (text or "").split()
    return {tuple(found[k:k + 5]) for k in range(max(1, len(found) - 4))} if found else set()


def likeness(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def test_edits_and_neighbours(edge_docs):
    rows = {(row["doc_id"], row["text"] or "") for row in edge_docs.collect()}
    ids = sorted((i for i, _ in rows if i is not None), reverse=True)
    assert len(ids) == len(set(ids))
    of = {i: text for i, text in rows if i is not None}
    found = [row for row in fingerprints.result(edge_docs).collect() if row["doc_id"] is not None]
    assert len(found) == len(ids) + 1  # one row is there twice
    for row in found:
        text = of[row["doc_id"]]
        assert row["n_chars"] == len(text)
        place = ids.index(row["doc_id"])
        if place + 1 < len(ids):
            lead = of[ids[place + 1]]
            edited = text[:len(text) - len(text) // 2] + lead[:len(text) // 2]
            assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
            if len(shingles(text) | shingles(edited)) <= fingerprints.K:
                assert row["near_edited"] == pytest.approx(likeness(shingles(text), shingles(edited)))
            assert abs(row["near_next"] - likeness(shingles(text), shingles(lead))) < 0.15
    equal = {row["fingerprint"] for row in found if of[row["doc_id"]] == of[0]}
    assert len(equal) == 1
    assert all(row["fingerprint"] == "" for row in found if not of[row["doc_id"]].strip())


def test_after_the_last_comes_the_first(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (5, "e f g h"), (9, "i j k l")], "doc_id long, text string")
    found = {row["doc_id"]: row["edited_sha256"] for row in fingerprints.result(docs).collect()}
    for i, edited in ((9, "i j e f"), (5, "e f a b"), (1, "a b i j")):
        # seven characters: the last three go
        text = {9: "i j k l", 5: "e f g h", 1: "a b c d"}[i]
        lead = {9: "e f g h", 5: "a b c d", 1: "i j k l"}[i]
        assert found[i] == hashlib.sha256((text[:4] + lead[:3]).encode()).hexdigest() and edited
    alone = fingerprints.result(docs.where("doc_id = 5")).first()
    assert alone["edited_sha256"] == hashlib.sha256(b"e f e f").hexdigest() and alone["near_next"] == 1.0


def test_parts_merge_into_the_whole(spark):
    words = [f"w{k % 900}" for k in range(2000)]
    parts = [(1, " ".join(words[k:k + 104])) for k in range(0, 2000, 100)]  # parts overlap by four words
    parts += [(None, "a b c d e f"), (2, "")]
    sketches = fingerprints.with_sketch(spark.createDataFrame(parts, "doc_id long, text string"), "text", "sketch")
    merged = {row["doc_id"]: row["sketch"] for row in fingerprints.merged(sketches, "doc_id", "sketch").collect()}
    whole = fingerprints.with_sketch(spark.createDataFrame([(" ".join(words),)], "text string"), "text", "sketch").first()
    assert merged[1] == whole["sketch"] and merged[2] == [] and len(merged[None]) == 2


def test_estimates(spark):
    a, b = " ".join(f"a{k}" for k in range(3000)), " ".join(f"a{k}" for k in range(1500, 4500))
    row = spark.createDataFrame([(a, b)], "a string, b string")
    row = fingerprints.with_sketch(fingerprints.with_sketch(row, "a", "x"), "b", "y").select(
        fingerprints.resemblance("x", "y").alias("r"), fingerprints.containment("x", "y").alias("c"),
        fingerprints.distinct_shingles("x").alias("n"), fingerprints.merge("x", "y").alias("m"),
    ).withColumn("size", F.size("m")).first()
    assert abs(row["r"] - 1 / 3) < 0.13 and abs(row["c"] - 0.5) < 0.15 and abs(row["n"] - 2996) < 600 and row["size"] == 128


def test_no_documents(no_docs):
    assert fingerprints.result(no_docs).collect() == []
