"""Token counts that follow edits: a segment tree of pre-token stretches per document.

A document is cut into leaves at places where a pre-token starts whatever stands around (a blank between two characters that
aren't white space). So leaves encode on their own, and their counts add up. A tree of sums stands over them. An edit encodes anew
the leaves it touches, with those whose cut lies next to it, and adds up the sums above them; nothing else is read again.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civiclake.llm.common import id_and_bytes

TOKENIZER = "byte_bpe_50k.tiktoken"
#: Characters of a leaf, at least; it ends at the next safe cut.
LEAF = 512
_CUT = re.compile(r"(?<=\S) (?=\S)")

_encoders: dict[str, tiktoken.Encoding] = {}


def encoder(path: str) -> tiktoken.Encoding:
    if path not in _encoders:
        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        _encoders[path] = tiktoken.Encoding("counts", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


def cuts(text: str, start: int, end: int) -> list[int]:
    """Ends of the leaves of text[start:end], where both are safe cuts or the text's ends."""
    found, at = [], start
    while at < end:
        cut = _CUT.search(text, at + LEAF, end)
        at = cut.start() if cut else end
        found.append(at)
    return found


@dataclass
class Tree:
    """Leaf lengths in characters, and sums in heap order: node k has children 2k and 2k + 1; leaves start at ``width``."""

    lengths: list[int]
    sums: list[int]

    @property
    def width(self) -> int:
        return len(self.sums) // 2

    @property
    def tokens(self) -> int:
        return self.sums[1]


def _summed(counts: list[int]) -> list[int]:
    width = 1 << max(0, len(counts) - 1).bit_length()
    sums = [0] * width + counts + [0] * (width - len(counts))
    for node in range(width - 1, 0, -1):
        sums[node] = sums[2 * node] + sums[2 * node + 1]
    return sums


def build(text: str, encoding: tiktoken.Encoding) -> Tree:
    ends = cuts(text, 0, len(text))
    starts = [0, *ends[:-1]]
    counts = [len(encoding.encode_ordinary(text[a:b])) for a, b in zip(starts, ends)]
    return Tree([b - a for a, b in zip(starts, ends)], _summed(counts))


def edit(text: str, tree: Tree, start: int, removed: int, inserted: str, encoding: tiktoken.Encoding) -> tuple[str, Tree, int]:
    """The text and the tree after an edit, and how many characters were encoded anew. Places beyond the text are its end."""
    start = min(max(start, 0), len(text))
    end = min(start + max(removed, 0), len(text))
    changed = text[:start] + inserted + text[end:]
    # a leaf is touched if the edit reaches it, or a character that its cuts' safety depends on
    first, last, low, at = None, None, 0, 0
    for k, length in enumerate(tree.lengths):
        if at <= end + 1 and at + length >= start - 1:
            if first is None:
                first, low = k, at
            last = k
        at += length
    if first is None:
        first, last, low, high = 0, -1, 0, 0
    else:
        high = low + sum(tree.lengths[first:last + 1])
    ends = cuts(changed, low, high + len(changed) - len(text))
    starts = [low, *ends[:-1]]
    counts = [len(encoding.encode_ordinary(changed[a:b])) for a, b in zip(starts, ends)]
    lengths = [*tree.lengths[:first], *(b - a for a, b in zip(starts, ends)), *tree.lengths[last + 1:]]
    width = tree.width
    if len(lengths) == len(tree.lengths):
        sums = tree.sums.copy()
        sums[width + first:width + first + len(counts)] = counts
        nodes = {(width + k) // 2 for k in range(first, first + len(counts))}
        while nodes - {0}:
            for node in nodes:
                sums[node] = sums[2 * node] + sums[2 * node + 1]
            nodes = {node // 2 for node in nodes if node > 1}
    else:
        old = tree.sums[width:width + len(tree.lengths)]
        sums = _summed([*old[:first], *counts, *old[last + 1:]])
    return changed, Tree(lengths, sums), sum(b - a for a, b in zip(starts, ends))


STATE = "doc_id long, text binary, lengths array<int>, sums array<long>, n_tokens long"
_STATE = pa.schema([
    ("doc_id", pa.int64()), ("text", pa.binary()), ("lengths", pa.list_(pa.int32())), ("sums", pa.list_(pa.int64())),
    ("n_tokens", pa.int64()),
])


def trees(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", path: str | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``text`` as bytes, the tree's ``lengths`` and ``sums``, and ``n_tokens``.

    Counts are those of the tokenizer file at ``path`` for the whole text. Null and empty texts have no tokens. Repeated rows give
    repeated rows, an empty table an empty one. Other columns are ignored. The result can be stored, and edited later.
    """
    path = path or public_tokenizers.path(TOKENIZER)

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = [build(raw.decode("utf-8", "replace"), encoding) for raw in part.column("text").to_pylist()]
                arrays = ([x.lengths for x in found], [x.sums for x in found], [x.tokens for x in found])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *(pa.array(x, kind.type) for x, kind in zip(arrays, list(_STATE)[2:]))], schema=_STATE
                )

    return id_and_bytes(docs, id_column, text_column).mapInArrow(built, STATE)


EDIT = "struct<start: int, removed: int, inserted: string>"


def edited(state: DataFrame, edits: str, path: str | None = None) -> DataFrame:
    """The state after each row's edits, in order, with ``n_tokens_before`` and ``n_encoded``, the characters encoded anew.

    ``edits`` is a column of arrays of (start, removed, inserted), in characters. A null or empty array changes nothing; nulls
    inside an edit are 0 and the empty text; an edit that is null is skipped.
    """
    path = path or public_tokenizers.path(TOKENIZER)

    def changed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = encoder(path)
        for batch in batches:
            columns = {name: batch.column(name).to_pylist() for name in batch.schema.names}
            texts, found, encoded, before = [], [], [], []
            for raw, lengths, sums, own in zip(columns["text"], columns["lengths"], columns["sums"], columns["edits"]):
                text, tree, total = raw.decode("utf-8", "replace"), Tree(lengths, sums), 0
                before.append(tree.tokens)
                for one in own or []:
                    if one is not None:
                        text, tree, n = edit(
                            text, tree, one["start"] or 0, one["removed"] or 0, one["inserted"] or "", encoding
                        )
                        total += n
                texts.append(text.encode("utf-8", "replace"))
                found.append(tree)
                encoded.append(total)
            arrays = (columns["doc_id"], texts, [x.lengths for x in found], [x.sums for x in found], [x.tokens for x in found])
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x, kind.type) for x, kind in zip(arrays, _STATE)), pa.array(before, pa.int64()),
                 pa.array(encoded, pa.int64())],
                [*_STATE.names, "n_tokens_before", "n_encoded"],
            )

    chosen = state.select("doc_id", "text", "lengths", "sums", F.col(edits).cast(f"array<{EDIT}>").alias("edits"))
    return chosen.mapInArrow(changed, f"{STATE}, n_tokens_before long, n_encoded long")


def middle_edit() -> Column:
    """The edit of the registered query: at the middle, the text's first 40 characters take the place of 20."""
    text = F.col("text").cast("string")
    return F.array(F.struct(
        F.expr("char_length(cast(text as string)) div 2").cast("int").alias("start"), F.lit(20).alias("removed"),
        F.substring(text, 1, 40).alias("inserted"),
    ))


def result(docs: DataFrame) -> DataFrame:
    """Token counts of all documents before and after one edit each, and how many characters that took."""
    after = edited(trees(docs).withColumn("edits", middle_edit()), "edits")
    return after.select(
        "doc_id", F.col("n_tokens_before").alias("n_tokens"), F.col("n_tokens").alias("n_tokens_edited"), "n_encoded"
    )
