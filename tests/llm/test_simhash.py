from collections import Counter

import pytest
import xxhash

from civiclake.llm import simhash
from civiclake.llm.components import components
from conftest import values


def slow_fingerprint(text):
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    shingles = [b" ".join(found[k:k + 3]) for k in range(max(1, len(found) - 2))]
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def roots(nodes, linked):
    parent = {node: node for node in nodes}

    def root(node):
        while parent[node] != node:
            node = parent[node]
        return node

    for a, b in linked:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    return {node: root(node) for node in nodes}


def expected(rows):
    prints = [slow_fingerprint(row[1]) for row in rows]
    distinct = sorted(set(prints))
    of = roots(distinct, [(a, b) for a in distinct for b in distinct if a < b and (a ^ b).bit_count() <= 3])
    least = {}
    for row, fp in zip(rows, prints):
        if row[0] is not None:
            least[of[fp]] = min(row[0], least.get(of[fp], row[0]))
    return Counter((row[0], f"{fp:016x}", least.get(of[fp])) for row, fp in zip(rows, prints))


def test_edge_documents(edge_docs, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 1000)
    rows = [tuple(row) for row in edge_docs.collect()]
    assert Counter(map(tuple, simhash.result(edge_docs).collect())) == expected(rows)


def test_test_data(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(row) for row in docs.collect()]
    assert Counter(map(tuple, simhash.result(docs).collect())) == expected(rows)


def test_no_documents(no_docs):
    assert simhash.result(no_docs).collect() == []


def test_links_are_all_pairs_within_distance(spark):
    bits = [0, 1, 1 << 63, 7, 1 << 31 | 1 << 32 | 1, 0b1111 << 30, 0xFFFF, 0xFFFE, (1 << 40) | 3, 3]
    signed = [x - (1 << 64) if x >> 63 else x for x in bits]
    found = {tuple(sorted(row)) for row in simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long")).collect()}
    near = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 3}
    assert found == near
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(0,)], "fp long"), 4)


def test_components(spark):
    linked = [(k, k + 1) for k in range(40)] + [(k * 7 % 30 + 100, k * 11 % 30 + 100) for k in range(25)] + [(7, 7), (3, 4), (4, 3)]
    linked.append((5, None))
    frame = spark.createDataFrame(linked, "a long, b long").repartition(8)
    real = [(a, b) for a, b in linked if b is not None and a != b]
    of = roots({x for pair in real for x in pair}, real)
    assert values(components(frame), "node", "root") == sorted(of.items())
    assert components(frame.limit(0)).collect() == []
