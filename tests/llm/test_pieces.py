"""Codes by the prefix table next to the sentencepiece library's."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from civiclake.llm import pieces

PATH = public_tokenizers.path(pieces.MODEL)
NASTY = "ab cde\n\t the  ing é ünï中文😀　▁=-*# \x00\x7f.,;ﬁ한국어日本語กข²½<s></s><0x0A>123"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return pieces.Pieces(PATH)


def texts(library):
    rng = random.Random(3)
    for k in range(1500):
        yield "".join(rng.choice(NASTY) for _ in range(rng.randrange(60)))
        yield "".join(library.id_to_piece(rng.randrange(259, 32000)) for _ in range(rng.randrange(1, 15)))
        yield "".join(rng.choice("aeinrstol =-.,") for _ in range(rng.randrange(200)))
    yield from [" " * 5000, "a" * 9000, "=" * 3000 + " " * 77, "the" * 3000, "中文字" * 2000, "word, " * 4000, "", " "]


def test_ids_and_text_are_the_library_s(model, library):
    for text in texts(library):
        ids = library.encode(text, add_eos=True)
        assert model.encode(text) == ids
        assert model.decode(ids) == library.decode(ids)


def test_decode_of_any_ids(model, library):
    rng = random.Random(4)
    for _ in range(2000):
        ids = [rng.randrange(32000) if rng.random() < 0.6 else rng.randrange(259) for _ in range(rng.randrange(12))]
        assert model.decode(ids) == library.decode(ids)


def test_a_full_memory_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 7)
    model = pieces.Pieces(PATH)
    for text in list(texts(library))[:600]:
        assert model.encode(text) == library.encode(text, add_eos=True)


def test_compatible_pairs_are_those_that_merge_to_themselves(model):
    rng = random.Random(5)
    names = [name for name in model.ids if len(name) < 8]
    for _ in range(3000):
        left, token = rng.choice(names), rng.choice(names)
        assert model._compatible(left, token) == (model.merged(left + token)[-1][1] == [left, token])


def test_result_on_edge_documents(spark, edge_docs, library):
    rows = edge_docs.collect()
    expected = []
    for row in rows:
        ids = library.encode(row["text"] or "", add_eos=True)
        listed, text = " ".join(map(str, ids)), library.decode(ids)
        expected.append((row["doc_id"], len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (listed, text))))
    found = [tuple(row) for row in pieces.result(edge_docs).collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)


def test_encode_and_decode_frames(spark, edge_docs, no_docs):
    coded = pieces.encode(edge_docs)
    assert coded.columns == ["doc_id", "ids"]
    back = {(row["doc_id"], row["text"]) for row in pieces.decode(coded).collect()}
    assert back == {(row["doc_id"], row["text"] or "") for row in edge_docs.collect()}
    assert pieces.encode(no_docs).collect() == pieces.result(no_docs).collect() == []
    assert pieces.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")).collect()[0]["text"] == ""
