import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from civiclake.llm import bpe

PATH = public_tokenizers.path(bpe.TOKENIZER)
PIECES = [
    "a", "b", "é", "Z", " ", "  ", "\n", "'s", "'ll", "1", "23", "<|endoftext|>", "<|startoftext|>", "<|", "end", "!", "??", "é",
    "́", "ㄱ", "가", "가", "中文", "İ", "Σ", "ß", "ſ", " ", "\x1c", "😀", "‍", "ﬁ", "K",
]


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(PATH)
    found.no_truncation()
    found.no_padding()
    return found


@pytest.mark.parametrize("plain", [True, False])
def test_tree_gives_the_whole_texts_tokens(library, monkeypatch, plain):
    monkeypatch.setattr(bpe, "LEAF", 48)
    monkeypatch.setattr(bpe, "REACH", 4)
    codec, rng = bpe.Codec(PATH), random.Random(2)
    for k in range(300):
        text = "".join(rng.choice(PIECES[:12] if plain else PIECES) for _ in range(rng.randrange(500)))
        text = "x" * rng.randrange(900) if k % 20 == 0 else text
        ids = library.encode(text, add_special_tokens=False).ids
        assert codec.encode(text).tolist() == ids
        assert codec.decode(np.array(ids, np.uint32)) == library.decode(ids, skip_special_tokens=False)


def _scripts(rng, size):
    """Texts without a gap: letters, letters of two bytes, symbols, Chinese characters, Hangul, mixed with marks."""
    yield "".join(rng.choices("etaoinshrdlucmfwypvbgkjqxz", k=size))
    yield "".join(rng.choices("aeé\u0142\u00f8zABßk", k=size))
    yield "".join(rng.choices("!?.-=#*+_/'", k=size))
    yield "".join(chr(rng.randrange(0x4E00, 0x9FA0)) for _ in range(size))
    yield "".join(rng.choices("가나다라abc中", k=size))
    yield "".join(rng.choices("ab\u0301c\u0915\u093c\u0958\u1112\u1161\u11ab", k=size))
    yield "ab" * (size // 2)
    yield "a" * size
    yield "".join(rng.choices(["s", "'s", "'ll", "ll", "'"], k=size // 2))


@pytest.mark.parametrize("leaf, reach, long", [(48, 4, 8), (300, 32, 64)])
def test_tree_inside_a_pre_token(library, monkeypatch, leaf, reach, long):
    monkeypatch.setattr(bpe, "LEAF", leaf)
    monkeypatch.setattr(bpe, "REACH", reach)
    monkeypatch.setattr(bpe, "LONG", long)
    codec, rng = bpe.Codec(PATH), random.Random(4)
    for _ in range(12):
        for text in _scripts(rng, rng.randrange(600, 2500)):
            assert codec.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("script", [0, 2, 3])
def test_work_on_text_without_a_gap(library, monkeypatch, script):
    text = list(_scripts(random.Random(5), 400_000))[script]
    codec, sizes = bpe.Codec(PATH), []
    spans = codec.spans
    monkeypatch.setattr(codec, "spans", lambda part, offset: sizes.append(len(part)) or spans(part, offset))
    assert codec.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
    assert sum(sizes) < 2 * len(text) and max(sizes) <= bpe.LEAF


def test_memory_of_words_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED_CHARACTERS", 1000)
    codec = bpe.Codec(PATH)
    for k in range(20):
        codec.ids("x" * (300 + k))
    assert sum(map(len, codec.known)) < 2000


def test_every_plain_character(library):
    codec = bpe.Codec(PATH)
    for point in range(0x500):
        text = f"ab{chr(point)}cd {chr(point)}1{chr(point)} 'S{chr(point)}'s"
        assert codec.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_documents(edge_docs, library, monkeypatch):
    monkeypatch.setattr(bpe, "SPLIT", 700)  # so that several texts are dealt out in pieces
    expected = Counter()
    for row in edge_docs.collect():
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected[(
            row["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest(),
        )] += 1
    assert Counter(map(tuple, bpe.result(edge_docs).collect())) == expected


def test_encode_then_decode(edge_docs, library):
    tokens = bpe.encode(edge_docs)
    texts = Counter((row["doc_id"], row["text"]) for row in bpe.decode(tokens).collect())
    assert texts == Counter(
        (row["doc_id"], library.decode(library.encode(row["text"] or "", add_special_tokens=False).ids, skip_special_tokens=False))
        for row in edge_docs.collect()
    )


def test_no_documents(no_docs):
    assert bpe.result(no_docs).collect() == [] and bpe.encode(no_docs).collect() == []
