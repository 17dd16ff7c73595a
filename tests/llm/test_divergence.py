"""Source divergence next to sums over plain dictionaries."""

import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from civiclake.llm import divergence

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def brute_force(rows, least, ranks=50):
    """rows: (lang, source, text)."""
    rows = [(lang or "", source or "", terms(text)) for lang, source, text in rows]
    docs, counts = Counter(), Counter()
    for lang, source, found in rows:
        docs.update((lang, term) for term in set(found))
        counts.update((lang, source, term) for term in found)
    out = []
    for lang in {row[0] for row in rows}:
        kept = [term for (of, term), n in docs.items() if of == lang and n >= least]
        sources = {row[1] for row in rows if row[0] == lang}

        def shares(count):
            total = sum(count.values())
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        of = {source: shares({t: counts[lang, source, t] for t in kept}) for source in sources}
        whole = shares({t: sum(counts[lang, source, t] for source in sources) for t in kept})
        for source, p in of.items():
            pairs = [(other, sum(abs(p[t] - q[t]) for t in kept)) for other, q in of.items() if other != source]
            most = [(t, p[t] - whole[t]) for t in kept if counts[lang, source, t] and p[t] > whole[t]]
            for part, items in ("pair", pairs), ("term", most):
                items.sort(key=lambda item: (-item[1], item[0].encode()))
                for rank, (item, value) in enumerate(items if part == "pair" else items[:ranks], 1):
                    out.append((lang, source, part, item, value, rank))
    return sorted(out)


def found(df):
    return sorted(tuple(row) for row in df.collect())


def documents():
    rng = random.Random(8)
    vocabulary = ["a", "Be", "sea", "ünï", "中文字", "x" * 8, "y" * 9, "z" * 16, "w" * 17, "v" * 33, "u" * 200, "it's", "é", "longerword", "b-c", "1a2"]
    for k in range(400):
        lang, source = rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", "s3", None, "é"])
        yield k, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(12))), lang, source
    yield from [(900, None, "en", "s1"), (901, "", "fr", "only"), (902, "alone here", "xx", "a"), (903, "alone", "xx", "b"), (904, "q" * 300_000, "en", "s9")]


@pytest.mark.parametrize("least", [1, 3, 30])
def test_equals_brute_force(spark, least, monkeypatch):
    rows = list(documents()) * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(5)
    expected = brute_force([(lang, source, text) for _, text, lang, source in rows], least)
    assert found(divergence.audit(docs, least=least)) == expected
    monkeypatch.setattr(divergence, "BLOCK_ROWS", 7)  # many blocks
    assert found(divergence.audit(docs, least=least)) == expected


def test_edge_documents(edge_docs, no_docs):
    rows = [(row["lang"], row["source"], row["text"]) for row in edge_docs.collect()]
    assert found(divergence.audit(edge_docs, least=1)) == brute_force(rows, 1)
    assert divergence.audit(no_docs).collect() == []


def test_other_column_names(spark):
    rows = [("a b", "x", "s"), ("a", "x", "t")]
    docs = spark.createDataFrame(rows, "body string, tongue string, origin string")
    expected = brute_force([(lang, source, text) for text, lang, source in rows], 1)
    assert found(divergence.audit(docs, "tongue", "origin", "body", least=1)) == expected


def test_blocks_merge_to_the_same_counts(monkeypatch):
    rows = [(lang or "", source or "", text or "") for _, text, lang, source in documents()]
    expected = Counter((lang, source, term) for lang, source, text in rows for term in terms(text))
    columns = {name: [row[k].encode() for row in rows] for k, name in enumerate(("lang", "source", "text"))}
    batches = pa.Table.from_pydict(columns, pa.schema([(name, pa.binary()) for name in columns])).to_batches(max_chunksize=37)
    for text_bytes, merged_rows in (1 << 22, 1 << 20), (50, 20), (1, 1):
        monkeypatch.setattr(divergence, "TEXT_BYTES", text_bytes)
        monkeypatch.setattr(divergence, "MERGED_ROWS", merged_rows)
        found = Counter()
        for batch in divergence._counted(iter(batches)):
            for lang, source, term, n in zip(*(batch.column(name).to_pylist() for name in ("lang", "source", "term", "n"))):
                found[lang.decode(), source.decode(), term.decode()] += n
        assert found == expected


def test_small_dense_parts_give_the_same_sums(monkeypatch):
    rng = random.Random(1)
    groups = pd.DataFrame({"lang": "x", "block": 0, "source": list("abcde"), "none": [3, 1, 4, 1, 5]})
    rows = pd.DataFrame([("x", 0, s, f"t{k}", rng.randrange(100)) for k in range(40) for s in "abcd" if rng.random() < 0.6],
                        columns=["lang", "block", "source", "term", "p"])
    whole = divergence._block_sums(rows, groups)
    monkeypatch.setattr(divergence, "CELLS", 9)
    assert divergence._block_sums(rows, groups).equals(whole)


def test_radix_order_is_the_bytes_order():
    rng = random.Random(2)
    spelled = [bytes(rng.randrange(1, 256) for _ in range(rng.randrange(9, 17))) for _ in range(3000)] * 2
    padded = np.array([x.ljust(16, b"\0") for x in spelled], dtype="S16")
    words = np.frombuffer(b"".join(x.ljust(16, b"\0") for x in spelled), dtype=">u8").reshape(-1, 2).astype(np.uint64)
    order = divergence._radix_order([words[:, 0], words[:, 1]], 8)
    assert order.tolist() == np.argsort(padded, kind="stable").tolist()
