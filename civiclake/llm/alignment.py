"""Alignment of two tokenizers' tokens over the same bytes, by products of sparse incidence matrices.

Each tokenizer's tokens of a text are the rows of a token-byte incidence matrix in compressed sparse rows (``Csr``). The product of
one matrix with the other's transpose, row by row after Gustavson, has an entry for each two tokens that share bytes, and its value
is how many: the overlap links. Bytes where tokens of both end cut the text into groups; the incidences of tokens and groups are
matrices of the same kind, and their product has an entry for each two tokens of a group. These are not spelled out: its row
lengths (the product's symbolic half) count them, and ``groups`` returns the members.

The matrices of many texts are laid side by side as one block-diagonal matrix. Corpus-wide counts of linked id pairs are summed
from one row per bundle of texts and pair; counts come back to the bundles the same way, where each text's links are looked up.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from civiclake.llm.common import id_and_bytes, stored

FIRST = "byte_bpe_50k.json"
SECOND = "piece_bpe_32k.model"
#: Bytes of text in a bundle (one text at least), and matrix entries multiplied at once.
BUNDLE_BYTES = 4 << 20
ENTRIES = 1 << 20

# Up to here character classes are the same in all libraries; other texts are left to the file's own.
_COMMON = re.compile("[^\x00-ɏ]")


@dataclass
class Csr:
    """A sparse matrix of ones: row k has the columns ``indices[indptr[k]:indptr[k + 1]]``, ascending."""

    indptr: np.ndarray
    indices: np.ndarray
    columns: int

    def times(self, other: Csr, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows ``low`` to ``high`` of the product, as (row, column, value): each row's entries pick rows of ``other``, whose
        columns are merged and counted."""
        inner = self.indices[self.indptr[low]:self.indptr[high]]
        row = np.repeat(np.arange(low, high), np.diff(self.indptr[low:high + 1]))
        size = other.indptr[inner + 1] - other.indptr[inner]
        row = np.repeat(row, size)
        place = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(other.indptr[inner], size)
        key = row * other.columns + other.indices[place]
        if len(key) and not (key[1:] >= key[:-1]).all():
            key.sort()
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, dtype=np.int64)
        value = np.diff(np.append(first, len(key)))
        return key[first] // max(1, other.columns), key[first] % max(1, other.columns), value

    def product(self, other: Csr) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The product in blocks of whole rows, of at most ENTRIES entries of this matrix or one row."""
        low, rows = 0, len(self.indptr) - 1
        while low < rows:
            high = max(low + 1, int(np.searchsorted(self.indptr, self.indptr[low] + ENTRIES, side="right")) - 1)
            yield self.times(other, low, min(high, rows))
            low = high

    def row_lengths(self, other: Csr) -> np.ndarray:
        """Entries that each row of this matrix picks from ``other``, without listing them."""
        lengths = np.diff(other.indptr)[self.indices]
        total = np.concatenate(([0], np.cumsum(lengths)))
        return total[self.indptr[1:]] - total[self.indptr[:-1]]


def token_bytes(ends: np.ndarray) -> Csr:
    """Tokens by the bytes they cover, from where each ends."""
    size = int(ends[-1]) if len(ends) else 0
    return Csr(np.concatenate(([0], ends)).astype(np.int64), np.arange(size), size)


def transposed(matrix: Csr) -> Csr:
    rows = np.repeat(np.arange(len(matrix.indptr) - 1), np.diff(matrix.indptr))
    order = np.argsort(matrix.indices, kind="stable") if (np.diff(matrix.indices) < 0).any() else slice(None)
    counts = np.bincount(matrix.indices, minlength=matrix.columns)
    return Csr(np.concatenate(([0], np.cumsum(counts))), rows[order], len(matrix.indptr) - 1)


def token_groups(ends: np.ndarray, group_ends: np.ndarray) -> Csr:
    """Tokens by their group."""
    return Csr(np.arange(len(ends) + 1), np.searchsorted(group_ends, ends), len(group_ends))


class Pair:
    """Two tokenizers, with the bytes and the decimal names of their tokens."""

    def __init__(self, first: str, second: str):
        self.first, self.second = first, sentencepiece.SentencePieceProcessor(model_file=second)
        with open(first, encoding="utf-8") as file:
            model = json.load(file)["model"]
        alphabet = self._alphabet()
        self.a_bytes = [b""] * (max(model["vocab"].values()) + 1)
        for token, k in model["vocab"].items():
            if all(c in alphabet for c in token):
                self.a_bytes[k] = bytes(alphabet[c] for c in token)
            else:
                self.a_bytes[k] = token.encode()
        self.b_bytes = []
        for k in range(self.second.vocab_size()):
            piece = self.second.id_to_piece(k)
            byte = self.second.is_byte(k)
            self.b_bytes.append(bytes([int(piece[1:-1], 16)]) if byte else piece.replace("▁", " ").encode())
        self.a_sizes, self.b_sizes = (np.array(list(map(len, x)), dtype=np.int64) for x in (self.a_bytes, self.b_bytes))
        merges = [x if isinstance(x, str) else " ".join(x) for x in model["merges"]]
        in_order = all(model["vocab"].get(x.replace(" ", "", 1)) == 256 + k for k, x in enumerate(merges))
        self.plain = None
        if in_order:
            ranks = {self.a_bytes[k]: k for k in range(256 + len(merges))}
            self.plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        names = [str(k) for k in range(max(len(self.a_bytes), len(self.b_bytes)))]
        self.names = {end: np.array([name + end for name in names], dtype=object) for end in ",|;"}

    @staticmethod
    def _alphabet() -> dict[str, int]:
        """The byte that each character of a byte-level vocabulary stands for: printable ones themselves, others from U+0100 on."""
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [byte for byte in range(256) if byte not in printable]
        return {chr(byte): byte for byte in printable} | {chr(0x100 + k): byte for k, byte in enumerate(others)}

    @cached_property
    def whole(self) -> Tokenizer:
        found = Tokenizer.from_file(self.first)
        found.encode_special_tokens = True
        found.no_truncation()
        found.no_padding()
        return found

    def codes(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """A text's ids by both; none if the text is empty or the tokens' bytes are not the text's with a blank before it."""
        none = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        if not raw:
            return none
        text, spaced = raw.decode("utf-8", "replace"), b" " + raw
        if self.plain is None or _COMMON.search(text):
            a = self.whole.encode(" " + text, add_special_tokens=False).ids
        else:
            a = self.plain.encode_ordinary(" " + text)
        b = self.second.encode(text)
        if b"".join(map(self.a_bytes.__getitem__, a)) != spaced or b"".join(map(self.b_bytes.__getitem__, b)) != spaced:
            return none
        return np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)


_loaded: dict[tuple[str, str], Pair] = {}


def pair(first: str, second: str) -> Pair:
    if (first, second) not in _loaded:
        _loaded.clear()
        _loaded[first, second] = Pair(first, second)
    return _loaded[first, second]


class Aligned:
    """The tokens of some texts by both tokenizers, side by side. ``a_at[k]:a_at[k + 1]`` are those of text k."""

    def __init__(self, of: Pair, texts: list[bytes]):
        codes = [of.codes(text) for text in texts]
        none = np.zeros(0, dtype=np.int64)
        self.a, self.b = (np.concatenate([none, *(code[k] for code in codes)]) for k in (0, 1))
        self.a_at, self.b_at = (np.concatenate(([0], np.cumsum([len(code[k]) for code in codes], dtype=np.int64))) for k in (0, 1))
        self.a_ends, self.b_ends = np.cumsum(of.a_sizes[self.a]), np.cumsum(of.b_sizes[self.b])
        self.group_ends = np.intersect1d(self.a_ends, self.b_ends, assume_unique=True)
        self.a_groups, self.b_groups = token_groups(self.a_ends, self.group_ends), token_groups(self.b_ends, self.group_ends)
        self.names = of.names

    def links(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Places of linked tokens and the bytes they share, by the first's place."""
        return token_bytes(self.a_ends).product(transposed(token_bytes(self.b_ends)))

    def per_text(self, per_a: np.ndarray) -> np.ndarray:
        """Sums over each text's first tokens."""
        total = np.concatenate(([0], np.cumsum(per_a)))
        return total[self.a_at[1:]] - total[self.a_at[:-1]]

    def groups_per_text(self) -> np.ndarray:
        last = np.zeros(len(self.a), dtype=np.int64)
        last[np.searchsorted(self.a_ends, self.group_ends)] = 1
        return self.per_text(last)

    def shared_per_text(self) -> np.ndarray:
        """Pairs of tokens that share a group."""
        return self.per_text(self.a_groups.row_lengths(transposed(self.b_groups)))

    def spelled(self) -> list[str]:
        """Each text's groups as ``a,a|b;a|b,b``; '' without tokens."""
        a_group, b_group = self.a_groups.indices, self.b_groups.indices
        a_last = np.diff(a_group, append=len(self.group_ends)) > 0
        b_last = np.diff(b_group, append=len(self.group_ends)) > 0
        out = np.empty(len(self.a) + len(self.b), dtype=object)
        out[np.arange(len(self.a)) + np.searchsorted(b_group, a_group)] = np.where(a_last, self.names["|"][self.a], self.names[","][self.a])
        out[np.arange(len(self.b)) + np.searchsorted(a_group, b_group, side="right")] = np.where(
            b_last, self.names[";"][self.b], self.names[","][self.b]
        )
        at = (self.a_at + self.b_at).tolist()
        return ["".join(out[low:high].tolist())[:-1] for low, high in zip(at, at[1:])]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of at most BUNDLE_BYTES of text, or one row."""
    for batch in batches:
        sizes = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(sizes, (int(sizes[at - 1]) if at else 0) + BUNDLE_BYTES, side="right")))
            yield batch.slice(at, end - at)
            at = end


def _packed(values: np.ndarray) -> bytes:
    """Numbers below 2^32, their bytes of equal weight side by side, compressed."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(raw: bytes, count: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(raw, decompressed_size=4 * count, codec="zstd", asbytes=True), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(4, count).T).view("<u4").ravel().astype(np.int64)


_NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "n_shared"]
_BUNDLE = (
    "bundle long, pairs array<long>, counts array<long>, doc_ids array<long>, digests array<string>, "
    "numbers array<long>, kinds long, places binary, times binary"
)
_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, n_shared long"


def _bundled(first: str, second: str):
    """Batches of texts to one row each: its distinct id pairs with their links, and each text's pairs by their places there."""

    def bundled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, task = pair(first, second), TaskContext.get().partitionId()
        for number, part in enumerate(_slices(batches)):
            texts = Aligned(of, part.column("text").to_pylist())
            width, per_a, keys = len(of.b_bytes), np.zeros(len(texts.a), dtype=np.int64), [np.zeros(0, dtype=np.int64)]
            for a, b, _ in texts.links():
                keys.append(texts.a[a] * width + texts.b[b])
                per_a += np.bincount(a, minlength=len(per_a))
            pairs, place, counts = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
            n_links = texts.per_text(per_a)
            # of each text: the places of its pairs, ascending, and how often they come
            kinds, times = np.unique(np.repeat(np.arange(len(n_links)), n_links) * (len(pairs) + 1) + place, return_counts=True)
            text, place = kinds // (len(pairs) + 1), kinds % (len(pairs) + 1)
            steps = place.copy()
            same = text[1:] == text[:-1]
            steps[1:][same] -= place[:-1][same]
            n_kinds = np.bincount(text, minlength=len(n_links))
            digests = [hashlib.sha256(x.encode()).hexdigest() if x else "" for x in texts.spelled()]
            numbers = np.stack([
                np.diff(texts.a_at), np.diff(texts.b_at), texts.groups_per_text(), n_links, texts.shared_per_text(), n_kinds,
            ])
            row = {
                "bundle": [(task << 32) + number], "pairs": [pairs], "counts": [counts], "doc_ids": [part.column("doc_id").to_pylist()],
                "digests": [digests], "numbers": [numbers.ravel()], "kinds": [len(kinds)], "places": [_packed(steps)],
                "times": [_packed(times)],
            }
            yield pa.RecordBatch.from_pydict(row, schema=_BUNDLE_SCHEMA)

    return bundled


_BUNDLE_SCHEMA = pa.schema([
    ("bundle", pa.int64()), ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("doc_ids", pa.list_(pa.int64())),
    ("digests", pa.list_(pa.string())), ("numbers", pa.list_(pa.int64())), ("kinds", pa.int64()), ("places", pa.binary()),
    ("times", pa.binary()),
])


def _looked_up(bundles: pa.Table, answers: pa.Table) -> pa.Table:
    """A bundle's texts, their links looked up in the corpus-wide counts of its pairs."""
    out = []
    for row in bundles.to_pylist():  # one row
        size = answers.num_rows
        count, best = np.zeros(size + 1, dtype=np.int64), np.zeros(size + 1, dtype=np.int64)
        place = answers.column("place").to_numpy()
        count[place], best[place] = answers.column("count").to_numpy(), answers.column("best").to_numpy()
        numbers = np.array(row["numbers"], dtype=np.int64).reshape(len(_NUMBERS) + 1, -1)
        n_kinds = numbers[-1]
        ends = np.cumsum(n_kinds)
        places, times = _unpacked(row["places"], row["kinds"]), _unpacked(row["times"], row["kinds"])
        # places are steps from the one before within a text
        total = np.concatenate(([0], np.cumsum(places)))
        places = total[1:] - np.repeat(total[ends - n_kinds], n_kinds)

        def per_text(values: np.ndarray) -> np.ndarray:
            sums = np.concatenate(([0], np.cumsum(values)))
            return sums[ends] - sums[ends - n_kinds]

        columns = dict(zip(_NUMBERS, numbers)) | {
            "doc_id": row["doc_ids"], "groups_sha256": row["digests"],
            "n_best": per_text(best[places] * times), "count_sum": per_text(count[places] * times),
        }
        out.append(pa.Table.from_pydict(columns).select(_RESULT_SCHEMA.names).cast(_RESULT_SCHEMA))
    return pa.concat_tables(out) if out else _RESULT_SCHEMA.empty_table()


_RESULT_SCHEMA = pa.schema([
    (name, pa.string() if name == "groups_sha256" else pa.int64()) for name in (x.split()[0] for x in _RESULT.split(", "))
])


def _paths(first: str | None, second: str | None) -> tuple[str, str]:
    return first or public_tokenizers.path(FIRST), second or public_tokenizers.path(SECOND)


def align(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", first: str | None = None, second: str | None = None
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``; tokens by the files ``first`` (byte-level, of the text after a blank) and ``second``;
    groups; overlap links; ``n_best`` of them whose id pair is the corpus's most frequent for the second id, ties included;
    ``count_sum``, the corpus-wide frequency of the pair summed over links; the SHA-256 of the groups' ids; pairs within groups.

    Null and empty texts, and texts whose tokens don't spell the text (U+2581 in it), have zeros and ''. Repeated rows stay and
    count as often as they come; an empty table gives an empty one. Other columns are ignored. A task holds one text whole.
    """
    paths = _paths(first, second)
    bundles = stored(id_and_bytes(docs, id_column, text_column).mapInArrow(_bundled(*paths), _BUNDLE), "bundles")
    asked = bundles.select("bundle", F.posexplode(F.arrays_zip("pairs", "counts")).alias("place", "of")).select(
        "bundle", "place", F.col("of.pairs").alias("pair"), F.col("of.counts").alias("n")
    )
    width = sentencepiece.SentencePieceProcessor(model_file=paths[1]).vocab_size()
    counts = stored(
        asked.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("b", F.col("pair") % F.lit(width)), "pair-counts"
    )
    # one row per id of the second vocabulary at most
    most = F.broadcast(counts.groupBy("b").agg(F.max("count").alias("most")))
    scored = counts.join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).cast("int").alias("best"))
    answers = asked.select("bundle", "place", "pair").join(scored.hint("merge"), "pair").select("bundle", "place", "count", "best")
    kept = bundles.select(F.col("bundle").alias("of"), "doc_ids", "digests", "numbers", "kinds", "places", "times")
    return kept.groupBy("of").cogroup(answers.groupBy("bundle")).applyInArrow(_looked_up, _RESULT)


def links(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", first: str | None = None, second: str | None = None
) -> DataFrame:
    """One row per overlap link: ``doc_id``, places from 0 and ids of the two tokens, and the bytes they share. Texts as in ``align``."""
    paths = _paths(first, second)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = pair(*paths)
        for part in _slices(batches):
            texts = Aligned(of, part.column("text").to_pylist())
            for a, b, shared in texts.links():
                for low in range(0, len(a), 1 << 16):
                    x, y, size = (values[low:low + (1 << 16)] for values in (a, b, shared))
                    text = np.searchsorted(texts.a_at, x, side="right") - 1
                    columns = [x - texts.a_at[text], y - texts.b_at[text], texts.a[x], texts.b[y], size]
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id").take(pa.array(text)), *map(pa.array, columns)],
                        ["doc_id", "a_place", "b_place", "a_id", "b_id", "n_bytes"],
                    )

    kind = "doc_id long, a_place long, b_place long, a_id long, b_id long, n_bytes long"
    return id_and_bytes(docs, id_column, text_column).mapInArrow(rows, kind)


def groups(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", first: str | None = None, second: str | None = None
) -> DataFrame:
    """One row per group: ``doc_id``, ``place`` from 0, ``a_ids``, ``b_ids``: any two tokens of them share the group. Texts as in ``align``."""
    paths = _paths(first, second)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = pair(*paths)
        for part in _slices(batches):
            texts = Aligned(of, part.column("text").to_pylist())
            number, start = len(texts.group_ends), np.searchsorted(texts.a_groups.indices, np.arange(len(texts.group_ends) + 1))
            b_start = np.searchsorted(texts.b_groups.indices, np.arange(number + 1))
            text = np.searchsorted(texts.a_at, start[:-1], side="right") - 1
            before = np.searchsorted(text, text)
            lists = [pa.ListArray.from_arrays(pa.array(x, pa.int32()), pa.array(y)) for x, y in ((start, texts.a), (b_start, texts.b))]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(text)), pa.array(np.arange(number) - before), *lists], ["doc_id", "place", "a_ids", "b_ids"]
            )

    return id_and_bytes(docs, id_column, text_column).mapInArrow(rows, "doc_id long, place long, a_ids array<long>, b_ids array<long>")


def result(docs: DataFrame) -> DataFrame:
    return align(docs)
