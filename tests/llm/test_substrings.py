import hashlib
from collections import Counter

import pytest

from civiclake.llm import substrings


def expected(rows, window):
    texts = [(row["text"] or "").encode().split() for row in rows]
    seen = Counter(tuple(of[k:k + window]) for of in texts for k in range(len(of) - window + 1))
    found = Counter()
    for row, of in zip(rows, texts):
        gone = [False] * len(of)
        for k in range(len(of) - window + 1):
            if seen[tuple(of[k:k + window])] > 1:
                gone[k:k + window] = [True] * window
        kept = b" ".join(word for word, out in zip(of, gone) if not out)
        found[(row["doc_id"], len(of), sum(gone), hashlib.sha256(kept).hexdigest())] += 1
    return found


@pytest.mark.parametrize("bundle", [300, 1 << 21])
def test_edge_documents(edge_docs, monkeypatch, bundle):
    monkeypatch.setattr(substrings, "BUNDLE", bundle)
    rows = edge_docs.collect()
    assert Counter(map(tuple, substrings.result(edge_docs).collect())) == expected(rows, substrings.WINDOW)


def test_chance_estimates_are_sorted_out(edge_docs, monkeypatch):
    """A sketch of few cells estimates nearly all windows repeated; the exact pass still finds the same."""
    monkeypatch.setattr(substrings, "SLICE_BITS", 4)
    monkeypatch.setattr(substrings, "CELLS", 0)
    found = substrings.deduplicate(edge_docs, window=5)
    told = Counter((r["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in found.collect())
    assert told == expected(edge_docs.collect(), 5)


def test_repeats_within_one_document(spark):
    docs = spark.createDataFrame([(1, "a b c d e x a b c d e y"), (2, "q " * 9)], "doc_id long, text string")
    found = {row["doc_id"]: row["text"] for row in substrings.deduplicate(docs, window=5).collect()}
    assert found == {1: "x y", 2: ""}


def test_no_documents(no_docs):
    assert substrings.result(no_docs).collect() == []


def test_words_that_a_linear_hash_confuses(spark):
    """Two words in an order of doublings, which agree under any polynomial modulo 2^64."""
    order = "ab"
    while len(order) < 2048:
        order += order.translate(str.maketrans("ab", "ba"))
    first, second = order[:1024], order[1024:]
    rest = " ".join(f"w{k}" for k in range(34))
    docs = spark.createDataFrame([(0, f"{first} {rest}"), (1, f"{second} {rest}")], "doc_id long, text string")
    assert [row["n_removed"] for row in substrings.result(docs).orderBy("doc_id").collect()] == [0, 0]
    docs = spark.createDataFrame([(0, f"{first} {rest}"), (1, f"{first} {rest}")], "doc_id long, text string")
    assert [row["n_removed"] for row in substrings.result(docs).orderBy("doc_id").collect()] == [35, 35]
