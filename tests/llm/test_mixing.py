import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from civiclake.llm import mixing


def water(sizes, weights, repeats):
    """Targets by sharing out the excess until none is above its limit."""
    total, full = sum(sizes), set()
    while True:
        rest = total - sum(repeats * sizes[k] for k in full)
        open_weight = sum(w for k, w in enumerate(weights) if k not in full)
        above = {k for k, w in enumerate(weights) if k not in full and rest * w / open_weight > repeats * sizes[k]} if open_weight else set()
        if not above:
            return [repeats * s if k in full else rest * weights[k] / open_weight for k, s in enumerate(sizes)]
        full |= above


def seats(shares, count):
    """Sainte-Laguë, one seat after another."""
    taken = [0] * len(shares)
    for _ in range(count):
        best = max(range(len(shares)), key=lambda k: (shares[k] / (2 * taken[k] + 1), -k))
        taken[best] += 1
    return taken


@pytest.mark.parametrize("shares, count", [
    ([7, 5, 3], 10), ([1, 1, 1, 1], 6), ([100, 1, 1, 1, 1, 1, 1], 9), ([5], 4), ([53, 24, 23], 0), ([3, 2, 0.5, 9, 9, 4], 5),
    ([1000, 999, 1, 2, 3, 5, 8, 13], 100),
])
def test_apportion(spark, shares, count):
    frame = spark.createDataFrame([(k, float(s), count, "g") for k, s in enumerate(shares)], "p long, s double, n long, g string")
    for group in (None, "g"):
        found = {row["p"]: row["quota"] for row in mixing.apportion(frame, group, "p", "s", "n").collect()}
        assert [found[k] for k in range(len(shares))] == seats(shares, count)


def check(docs, found, repeats=3):
    size = lambda text: len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    rows = docs.collect()
    assert Counter((row["doc_id"], row["size"]) for row in found) == Counter((row["doc_id"], size(row["text"])) for row in rows)
    sources = sorted({row["source"] for row in rows}, key=lambda s: (s is None, s or ""))
    sizes = [sum(size(row["text"]) for row in rows if row["source"] == s) for s in sources]
    targets = water(sizes, [(1, 2, 3)[k % 3] for k in range(len(sources))], repeats)
    assert sorted({(row["source_size"], round(row["target"], 6)) for row in found}) == sorted(
        {(s, round(t, 6)) for s, t in zip(sizes, targets)}
    )
    assert all(0 <= row["taken"] <= repeats * row["size"] for row in found)
    for s, t in zip(sizes, targets):
        shown = [row for row in found if (row["source_size"], round(row["target"], 6)) == (s, round(t, 6))]
        alike = sum((a, round(b, 6)) == (s, round(t, 6)) for a, b in zip(sizes, targets))
        assert abs(sum(row["taken"] for row in shown) - alike * t) <= alike * 2 * mixing.BLOCK


def test_edge_documents(edge_docs):
    check(edge_docs, mixing.result(edge_docs).collect())


def test_many_shards(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn(
        "source", F.when(F.col("doc_id") % 3 == 0, "hot").otherwise(F.col("source"))
    )
    found = mixing.mix(docs, shard_documents=7).collect()
    check(docs, found)
    assert sorted(map(tuple, found)) == sorted(map(tuple, mixing.mix(docs.repartition(9), shard_documents=7).collect()))


def test_sample_gives_the_words_the_mix_takes(edge_docs):
    def by_source(rows):
        found = {}
        for row in rows:
            found[row["source"]] = found.get(row["source"], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", row["text"] or ""))
        return found

    out = mixing.sample(edge_docs)
    assert out.columns == edge_docs.columns
    sizes, taken = by_source(edge_docs.collect()), by_source(out.collect())
    sources = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = water([sizes[s] for s in sources], [(1, 2, 3)[k % 3] for k in range(len(sources))], 3)
    for source, target in zip(sources, targets):
        assert abs(taken.get(source, 0) - target) <= 2 * mixing.BLOCK


def test_sample_cuts_at_words(spark):
    docs = spark.createDataFrame([(1, " a  b\nc d " * 40, "s"), (2, "x " * 7, "t")], "doc_id long, text string, source string")
    for row in mixing.sample(docs).collect():
        assert (" a  b\nc d " * 40).startswith(row["text"]) or ("x " * 7).startswith(row["text"])


def test_no_documents_and_no_words(spark, no_docs):
    assert mixing.result(no_docs).collect() == []
    blank = spark.createDataFrame([(1, " ", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert {(row["size"], row["target"], row["taken"]) for row in mixing.result(blank).collect()} == {(0, 0.0, 0)}
