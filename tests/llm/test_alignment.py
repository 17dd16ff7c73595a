"""Alignment by sparse products next to plain loops over offsets."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from civiclake.llm import alignment

NASTY = "ab cde\n\t the  ing é ünï中文😀　-*#\x00\x7f\x85\xa0\x1c.,;ﬁ한국어日本語กข²½Ƃǅ<s></s><|endoftext|><0x0A>123'll 's"


@pytest.fixture(scope="module")
def pair():
    return alignment.Pair(*alignment._paths(None, None))


@pytest.fixture(scope="module")
def libraries():
    first = Tokenizer.from_file(public_tokenizers.path(alignment.FIRST))
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(alignment.SECOND))


def brute_force(texts, pair, libraries):
    """Per text: counts, links and groups, from the libraries' ids and loops over bytes."""
    first, second = libraries
    found = []
    for text in texts:
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        spaced = (" " + text).encode()
        if b"".join(pair.a_bytes[k] for k in a) != spaced or b"".join(pair.b_bytes[k] for k in b) != spaced:
            a, b = [], []
        owner = [k for k, x in enumerate(b) for _ in pair.b_bytes[x]]
        links, at, a_ends = [], 0, []
        for k, x in enumerate(a):
            size = len(pair.a_bytes[x])
            links += [(k, j, n) for j, n in sorted(Counter(owner[at:at + size]).items())]
            at += size
            a_ends.append(at)
        b_ends = np.cumsum([len(pair.b_bytes[x]) for x in b]).tolist()
        groups, low, low_b = [], 0, 0
        for k, end in enumerate(a_ends):
            if end in b_ends:
                high_b = b_ends.index(end) + 1
                groups.append((a[low:k + 1], b[low_b:high_b]))
                low, low_b = k + 1, high_b
        found.append((a, b, links, groups))
    return found


def expected_rows(ids, texts, pair, libraries):
    found = brute_force([text or "" for text in texts], pair, libraries)
    counts = Counter((a[i], b[j]) for a, b, links, _ in found for i, j, _ in links)
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    rows = []
    for doc_id, (a, b, links, groups) in zip(ids, found):
        pairs = [(a[i], b[j]) for i, j, _ in links]
        listed = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        rows.append((
            doc_id, len(a), len(b), len(groups), len(links), sum(counts[p] == most[p[1]] for p in pairs), sum(counts[p] for p in pairs),
            hashlib.sha256(listed.encode()).hexdigest() if listed else "", sum(len(x) * len(y) for x, y in groups),
        ))
    return rows


def nasty_texts():
    rng = random.Random(6)
    texts = ["".join(rng.choice(NASTY) for _ in range(rng.randrange(50))) for _ in range(400)]
    texts += ["".join(map(chr, range(low, low + 16))) + " x" for low in range(0, 0x250, 16)]
    texts += ["".join(chr(rng.randrange(0x250)) for _ in range(40)) for _ in range(300)]
    return [*texts, "", None, "a▁b", "word " * 3000, "z" * 5000, "中" * 2000]


def test_ids_are_the_library_s(pair, libraries):
    for text in nasty_texts():
        a, b = pair.codes((text or "").encode())
        if len(a):
            assert a.tolist() == libraries[0].encode(" " + text, add_special_tokens=False).ids
            assert b.tolist() == libraries[1].encode(text)


def by_key(rows):
    return sorted(rows, key=lambda row: [(x is not None, x) for x in row])


def test_align_equals_loops(spark, pair, libraries):
    texts = nasty_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = [tuple(row) for row in alignment.align(docs).collect()]
    assert by_key(found) == by_key(expected_rows(range(len(texts)), texts, pair, libraries))


def test_edge_documents(edge_docs, no_docs, pair, libraries):
    rows = edge_docs.collect()
    expected = expected_rows([row["doc_id"] for row in rows], [row["text"] for row in rows], pair, libraries)
    assert by_key(tuple(row) for row in alignment.result(edge_docs).collect()) == by_key(expected)
    for of in alignment.result, alignment.links, alignment.groups:
        assert of(no_docs).collect() == []


def test_links_and_groups(spark, pair, libraries):
    texts = [text for text in nasty_texts() if text][:120]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = brute_force(texts, pair, libraries)
    links = [(k, i, j, a[i], b[j], n) for k, (a, b, links, _) in enumerate(found) for i, j, n in links]
    assert sorted(tuple(row) for row in alignment.links(docs).collect()) == sorted(links)
    groups = [(k, place, x, y) for k, (*_, groups) in enumerate(found) for place, (x, y) in enumerate(groups)]
    assert sorted(tuple(row) for row in alignment.groups(docs).collect()) == sorted(groups)


def test_small_blocks_give_the_same_links(pair, monkeypatch):
    texts = alignment.Aligned(pair, [(text or "").encode() for text in nasty_texts()])
    whole = [np.concatenate(x).tolist() for x in zip(*texts.links())]
    monkeypatch.setattr(alignment, "ENTRIES", 37)
    assert [np.concatenate(x).tolist() for x in zip(*texts.links())] == whole


def test_bundles_are_cut_by_bytes(monkeypatch):
    monkeypatch.setattr(alignment, "BUNDLE_BYTES", 10)
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(6)), "text": [b"a" * n for n in (4, 4, 4, 30, 0, 10)]})
    assert [part.column("doc_id").to_pylist() for part in alignment._slices(iter([batch]))] == [[0, 1], [2], [3], [4, 5]]


def test_product_is_the_dense_one():
    rng = np.random.default_rng(1)
    left, right = (rng.random((9, 11)) < 0.3), (rng.random((11, 7)) < 0.3)

    def csr(dense):
        return alignment.Csr(np.concatenate(([0], np.cumsum(dense.sum(axis=1)))), np.nonzero(dense)[1], dense.shape[1])

    out = np.zeros((9, 7), dtype=int)
    for row, column, value in csr(left).product(csr(right)):
        out[row, column] = value
    assert (out == left.astype(int) @ right.astype(int)).all()
    assert csr(left).row_lengths(csr(right)).tolist() == (left.astype(int) @ right.astype(int)).sum(axis=1).tolist()
    turned = alignment.transposed(csr(left))
    assert turned.indices.tolist() == np.nonzero(left.T)[1].tolist()
