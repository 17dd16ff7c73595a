import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from civiclake.llm import topk

SCHEMA = "vec_id long, embedding array<double>, score string, rank int, key long, block int"


def slow(rows, queries, k):
    whole = [
        (i, [math.floor(256 * x) for x in v]) for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    found = Counter()
    for q, own in whole:
        if q in queries:
            scored = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in whole if i != q)[:k]
            for rank, (score, i) in enumerate(scored, 1):
                found[(q, rank, i, -score)] += 1
    return found


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 9, i, None) for i, v in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    found = [(k, [rng.gauss(0, 1) * (1 + k % 7) for _ in range(6)]) for k in range(160)]
    found += [(k, [0.5, 0.25, -1.0, 0.0, 2.0, 1.0]) for k in range(200, 260)]  # ties, one common vector
    found += [
        (300, None), (301, [1.0, None]), (302, [float("nan")] * 6), (303, [float("inf")] + [0.0] * 5), (304, []), (305, [1.0, 2.0]),
        (None, [1.0] * 6), (150, [9.0] * 6), (150, [9.0] * 6), (306, [-0.001] * 6),
    ]
    return found


def test_against_brute_force(spark, rows, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 20)
    monkeypatch.setattr(topk, "CHUNK", 7)
    monkeypatch.setattr(topk, "ROWS", 4)
    monkeypatch.setattr(topk, "LADDER", 3)
    queries = {i for i, _ in rows if i is not None and i % 10 == 0}
    found = topk.top_k(frame(spark, rows), F.col("vec_id") % 10 == 0, k=4)
    assert Counter(map(tuple, found.collect())) == slow(rows, queries, 4)


def test_few_candidates_and_empty_tables(spark, rows):
    few = rows[:3]
    found = topk.top_k(frame(spark, few), F.col("vec_id") == 0)
    assert Counter(map(tuple, found.collect())) == slow(few, {0}, 5)
    assert topk.result(frame(spark, rows).limit(0)).collect() == []
    assert topk.top_k(frame(spark, rows), F.lit(False)).collect() == []


def test_short_vectors_are_pruned():
    rng = np.random.default_rng(1)
    queries, vectors = rng.integers(-500, 500, (8, 16)), rng.integers(-500, 500, (300, 16))
    scores = queries @ vectors.T
    least = np.sort(scores, axis=1)[:, -3].astype(float)
    found = topk.search_block(queries, np.full(8, -1), least, vectors, np.arange(300), np.eye(16), 3)
    assert {(q, i): s for q, i, s in found} == {
        (q, int(i)): int(scores[q, i]) for q in range(8) for i in np.argsort(-scores[q], kind="stable")[:3]
    }


def test_large_integers_stay_exact():
    big = np.array([[2**30 + 1, 3]], dtype=np.int64)
    assert topk._exact(big, big)[0, 0] == (2**30 + 1) ** 2 + 9


def test_too_long_vectors_are_refused(spark):
    with pytest.raises(Exception, match="64 bits"):
        topk.top_k(frame(spark, [(0, [1e300] * 2), (1, [1.0, 1.0])]), F.lit(True)).collect()
