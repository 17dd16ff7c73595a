"""Removal of word windows that occur more than once, by a count-min prefilter and an exact second pass.

Documents are packed into bundles, written once, so that every pass sees the same ones. Pass 1: each bundle sketches its windows
as hash cells with counts; the sketches are merged slice by slice, which overestimates counts and misses none, and each bundle
learns which of its cells are estimated repeated. Pass 2: only windows in such cells go on, by 128-bit digests; those found twice
are repeated. A word's digest is 128 bits of XXH3, keyed by a number drawn for each run, and a window's is that of its words'
digests, so no text can be made for two windows to agree. The sketch's hash is a cheap rolling one of the same word digests, which
may make different windows share a cell, but never parts equal ones. Both passes send a cell or hash at most once per bundle, so a window with any number of copies stays small, and
slices are cut by hash, so they are even. Answers are bits; nothing that grows with the data is broadcast or sent to the driver.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Callable, Iterator
from itertools import compress, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclake.llm.common import id_and_bytes, stored

WINDOW = 35
#: Bytes of text in a bundle; a longer text is a bundle of its own.
BUNDLE = 2 << 20
#: Cells of the sketch per window, so one window in so many is estimated repeated by chance.
CELLS = 16
#: Cells (as a power of two) that one task merges at once.
SLICE_BITS = 25

_BLANK = np.zeros(256, dtype=bool)
_BLANK[list(b" \t\n\x0b\x0c\r")] = True
#: Odd factors of the rolling hash.
_FACTOR = 0x9E3779B97F4A7C15
_tables: dict[int, np.ndarray] = {}


def _powers(factor: int, size: int) -> np.ndarray:
    """The first powers of an odd number modulo 2^64."""
    if factor not in _tables or len(_tables[factor]) < size:
        grown = np.full(max(size, 1 << 12), np.uint64(factor), dtype=np.uint64)
        grown[0] = 1
        _tables[factor] = np.multiply.accumulate(grown)
    return _tables[factor][:size]


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Words:
    """The words of a bundle's texts, joined by line ends: their places, and each one's text."""

    def __init__(self, data: bytes, sizes: np.ndarray, window: int):
        self.data, self.window = data, window
        inside = np.concatenate(([False], ~_BLANK[np.frombuffer(data, np.uint8)], [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = edges[::2], edges[1::2]
        self.texts = np.concatenate(([0], np.cumsum(sizes + 1)))  # where texts begin
        self.first_words = np.searchsorted(self.starts, self.texts)
        text = np.repeat(np.arange(len(sizes)), np.diff(self.first_words))
        last = len(self.starts) - window + 1
        # a window starts at a word whose text goes on for long enough
        self.at = np.flatnonzero(text[:last] == text[window - 1:]) if last > 0 else np.zeros(0, np.int64)

    def digests(self, key: int) -> bytes:
        """Sixteen bytes for each word."""
        return b"".join(map(xxhash.xxh3_128_digest, self.data.split(), repeat(key)))

    def hashes(self, digests: bytes) -> np.ndarray:
        """A 64-bit rolling hash of each window, for the sketch."""
        if not len(self.at):
            return np.zeros(0, np.uint64)
        words = np.frombuffer(digests, np.uint64)[::2]
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * _powers(_FACTOR, len(words)))))
        back = _powers(pow(_FACTOR, -1, 1 << 64), len(words))
        return _mixed((total[self.at + self.window] - total[self.at]) * back[self.at])

    def exact(self, digests: bytes, chosen: np.ndarray, key: int) -> tuple[np.ndarray, np.ndarray]:
        """The digests of the chosen windows, in two halves."""
        view, size = memoryview(digests), 16 * self.window
        found = b"".join(xxhash.xxh3_128_digest(view[at:at + size], key) for at in (16 * self.at[chosen]).tolist())
        both = np.frombuffer(found, np.uint64).reshape(-1, 2)
        return both[:, 0], both[:, 1]


def _unpacked(data: bytes, sizes, window: int) -> tuple[bytes, Words]:
    raw = zstandard.decompress(data)
    return raw, Words(raw, np.array(sizes, dtype=np.int64), window)


BUNDLES = "bundle long, ids array<long>, sizes array<long>, data binary, windows long"


def _bundles(window: int, most: int) -> Callable:
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size, number = [], [], 0, TaskContext.get().partitionId() << 32

        def bundle() -> pa.RecordBatch:
            raw, sizes = b"\n".join(texts), [len(text) for text in texts]
            return pa.RecordBatch.from_arrays([
                pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64())),
                pa.array([zstandard.compress(raw, 3)], pa.binary()),
                pa.array([len(Words(raw, np.array(sizes, np.int64), window).at)], pa.int64()),
            ], ["bundle", "ids", "sizes", "data", "windows"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                text = text.as_py()
                if texts and size + len(text) > most:
                    yield bundle()
                    ids, texts, size, number = [], [], 0, number + 1
                ids.append(doc_id)
                texts.append(text)
                size += len(text) + 1
        if texts:
            yield bundle()

    return packed


def _per_slice(keys: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """(slice, from, to) of sorted 64-bit keys; a slice is what the highest bits say."""
    if not len(keys):
        return []
    of = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    cuts = np.concatenate(([0], np.flatnonzero(of[1:] != of[:-1]) + 1, [len(of)]))
    return [(int(of[a]), int(a), int(b)) for a, b in zip(cuts[:-1], cuts[1:])]


QUESTIONS = "slice long, bundle long, content binary, many binary"
_QUESTIONS = pa.schema([("slice", pa.int64()), ("bundle", pa.int64()), ("content", pa.binary()), ("many", pa.binary())])
ANSWERS = "bundle long, slice long, bits binary"


def _cells(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct cells as sorted left-aligned keys, which of them have several windows, and the cell number of each window."""
    keys = hashes & ~np.uint64((1 << (64 - bits)) - 1)
    distinct, number, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return distinct, counts > 1, number


def _sketches(window: int, bits: int, slice_bits: int, key: int) -> Callable:
    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, words = _unpacked(row["data"], row["sizes"], window)
                cells, many, _ = _cells(words.hashes(words.digests(key)), bits)
                found = []
                for of, a, b in _per_slice(cells, bits - slice_bits):
                    within = ((cells[a:b] >> np.uint64(64 - bits)) & np.uint64((1 << slice_bits) - 1)).astype("<u4")
                    planes = within.view(np.uint8).reshape(-1, 4).T.tobytes()  # sorted, so the high bytes compress
                    found.append((of, row["bundle"], zstandard.compress(planes, 1), np.packbits(many[a:b]).tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, kind.type) for x, kind in zip(zip(*found), _QUESTIONS)] if found
                    else [pa.array([], kind.type) for kind in _QUESTIONS], schema=_QUESTIONS
                )

    return sketched


def _bits(packed: bytes, size: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed, np.uint8), count=size).astype(bool)


def _merged(slice_bits: int) -> Callable:
    """Adds up the sketches of a slice, counting to two, and answers each with its cells' estimates."""
    def merged(rows: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros(1 << slice_bits, np.uint8)
        sketches = []
        for content, many in zip(rows["content"], rows["many"]):
            cells = np.frombuffer(zstandard.decompress(content), np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()
            sketches.append(cells)
            counts[cells] = np.minimum(counts[cells] + 1 + _bits(many, len(cells)), 2)
        answers = [np.packbits(counts[cells] > 1).tobytes() for cells in sketches]
        return pd.DataFrame({"bundle": rows["bundle"], "slice": rows["slice"], "bits": answers})

    return merged


def _answered(answers: pd.DataFrame, slices: list[tuple[int, int, int]], size: int) -> np.ndarray:
    """The bits of all slices, in the order of the keys that were asked for."""
    given, found = dict(zip(answers["slice"], answers["bits"])), np.zeros(size, bool)
    for of, a, b in slices:
        found[a:b] = _bits(given[of], b - a)
    return found


def _suspects(row: pd.Series, answers: pd.DataFrame, window: int, bits: int, slice_bits: int, key: int):
    """A bundle's words, the numbers of its windows estimated repeated, and their 128-bit digests."""
    raw, words = _unpacked(row["data"], row["sizes"], window)
    digests = words.digests(key)
    cells, _, number = _cells(words.hashes(digests), bits)
    repeated = _answered(answers, _per_slice(cells, bits - slice_bits), len(cells))
    chosen = np.flatnonzero(repeated[number]) if len(number) else number
    return raw, words, chosen, *words.exact(digests, chosen, key)


def _distinct(high: np.ndarray, low: np.ndarray):
    """Sorted distinct pairs, which of them occur several times, and the number of each row's pair."""
    order = np.lexsort((low, high))
    high, low = high[order], low[order]
    new = np.concatenate(([True], (high[1:] != high[:-1]) | (low[1:] != low[:-1]))) if len(order) else np.zeros(0, bool)
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    counts = np.bincount(number, minlength=int(new.sum()))
    return high[new], low[new], counts > 1, number


def _asked(window: int, bits: int, slice_bits: int, key: int) -> Callable:
    def asked(bundles: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        row = bundles.iloc[0]
        _, _, _, high, low = _suspects(row, answers, window, bits, slice_bits, key)
        high, low, many, _ = _distinct(high, low)
        found = [
            (of, row["bundle"], high[a:b].tobytes() + low[a:b].tobytes(), np.packbits(many[a:b]).tobytes())
            for of, a, b in _per_slice(high, bits - slice_bits)
        ]
        return pd.DataFrame(found, columns=["slice", "bundle", "content", "many"])

    return asked


def _found_twice(rows: pd.DataFrame) -> pd.DataFrame:
    """Which hashes of a slice several bundles have, or one has several times."""
    both = [np.frombuffer(content, np.uint64).reshape(2, -1) for content in rows["content"]]
    many = np.concatenate([_bits(packed, x.shape[1]) for packed, x in zip(rows["many"], both)])
    _, _, shared, number = _distinct(np.concatenate([x[0] for x in both]), np.concatenate([x[1] for x in both]))
    shared = shared | (np.bincount(number, weights=many, minlength=len(shared)) > 0)
    cuts = np.cumsum([x.shape[1] for x in both])[:-1]
    answers = [np.packbits(x).tobytes() for x in np.split(shared[number], cuts)]
    return pd.DataFrame({"bundle": rows["bundle"], "slice": rows["slice"], "bits": answers})




def _removed(window: int, bits: int, slice_bits: int, key: int, with_text: bool) -> Callable:
    def removed(bundles: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        row = bundles.iloc[0]
        exact = answers["exact"]
        raw, words, chosen, high, low = _suspects(row, answers[~exact], window, bits, slice_bits, key)
        high, low, _, number = _distinct(high, low)
        repeated = _answered(answers[exact], _per_slice(high, bits - slice_bits), len(high))
        at = words.at[chosen[repeated[number]]] if len(chosen) else chosen
        change = np.zeros(len(words.starts) + 1, np.int64)
        np.add.at(change, at, 1)
        np.add.at(change, at + window, -1)
        kept = np.cumsum(change)[:-1] == 0
        found = []
        for k, doc_id in enumerate(row["ids"]):
            first, last, start = words.first_words[k], words.first_words[k + 1], words.texts[k]
            own = raw[start:start + row["sizes"][k]].split()
            text = b" ".join(compress(own, kept[first:last].tolist()))
            gone = int(last - first - kept[first:last].sum())
            found.append((doc_id, last - first, gone, text if with_text else hashlib.sha256(text).hexdigest()))
        out = pd.DataFrame(found, columns=["doc_id", "n_words", "n_removed", "kept"])
        out["doc_id"] = pd.array([None if pd.isna(x) else int(x) for x in out["doc_id"]], "Int64")
        return out

    return removed


def _deduplicated(docs: DataFrame, id_column: str, text_column: str, window: int, with_text: bool) -> DataFrame:
    bundles = stored(
        id_and_bytes(docs, id_column, text_column).mapInArrow(_bundles(window, BUNDLE), BUNDLES), "bundles"
    )
    windows = bundles.agg(F.sum("windows")).first()[0] or 0
    bits = max(SLICE_BITS, min(62, (CELLS * windows).bit_length()))
    parameters = window, bits, SLICE_BITS, secrets.randbits(63)
    packed = bundles.select("bundle", "ids", "sizes", "data")
    sketches = packed.mapInArrow(_sketches(*parameters), QUESTIONS)
    estimates = stored(sketches.groupBy("slice").applyInPandas(_merged(SLICE_BITS), ANSWERS), "estimates")
    suspects = packed.groupBy("bundle").cogroup(estimates.groupBy("bundle")).applyInPandas(_asked(*parameters), QUESTIONS)
    exact = suspects.groupBy("slice").applyInPandas(_found_twice, ANSWERS)
    answers = estimates.withColumn("exact", F.lit(False)).union(exact.withColumn("exact", F.lit(True)))
    kind = "doc_id long, n_words long, n_removed long, kept " + ("binary" if with_text else "string")
    return packed.groupBy("bundle").cogroup(answers.groupBy("bundle")).applyInPandas(_removed(*parameters, with_text), kind)


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``n_removed`` and ``text``, the kept words with blanks between.

    A word goes if any window of ``window`` words over it also starts elsewhere, in whatever document; the first copy goes too.
    Null texts have no words; texts shorter than a window lose none. A repeated row is another document, so both lose all words
    if they make a window. An empty table gives an empty one. Other columns are ignored. A task holds one bundle, or one text.
    """
    found = _deduplicated(docs, id_column, text_column, window, True)
    return found.select("doc_id", "n_words", "n_removed", F.col("kept").cast("string").alias("text"))


def result(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and the SHA-256 of the kept words."""
    found = _deduplicated(docs, "doc_id", "text", WINDOW, False)
    return found.withColumnRenamed("kept", "kept_sha256")


def oracle() -> str:
    return rf"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), starts AS (
  SELECT doc, words, unnest(range(1, len(words) - {WINDOW - 2})) AS pos FROM docs WHERE len(words) >= {WINDOW}
), windows AS (
  SELECT doc, pos, words[pos:pos + {WINDOW - 1}] AS content FROM starts
), repeated AS (
  SELECT content FROM windows GROUP BY content HAVING count(*) > 1
), removed AS (
  SELECT DISTINCT doc, unnest(range(pos, pos + {WINDOW})) AS place FROM windows SEMI JOIN repeated USING (content)
), placed AS (
  SELECT doc, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM docs
), kept AS (
  SELECT doc, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS text FROM placed ANTI JOIN removed USING (doc, place) GROUP BY doc
)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc)
"""
