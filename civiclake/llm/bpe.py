"""BPE encoding and decoding of whole texts, long ones by tree concatenation.

A long text is cut into halves again and again. The parts are encoded on their own, in parallel, and joined pairwise: a window
around each join is encoded anew and grows until it agrees with both sides, that is, until it shares a segment with either
side, away from all cut ends. A segment is a pre-token, or, in a pre-token of at least LONG characters, the tokens between two
places where a token's end is a character's end. At a segment's end both go on alike: at a pre-token's end because a tokenizer
looks at the text from there alone; inside a pre-token because tokens are a text's BPE exactly if each neighbouring pair is the
BPE of its own text (a first merge across a border would be the pair's first, too), and the pairs at a shared segment's end
are pairs of one of the two. So the left part up to the first shared segment's end, the window, and the right part from the
second's are exactly the whole text's tokens, with or without a gap in it.

Texts of up to SPLIT characters are one row for one task, cut into leaves within it; longer ones are dealt out in pieces.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from civiclake.llm.common import id_and_bytes

TOKENIZER = "word_bpe_49k.json"
#: Characters of a leaf, and of a piece of a text that is dealt out to several tasks.
LEAF = 1 << 14
SPLIT = 1 << 16
#: First reach of a window on either side of a join.
REACH = 128
#: Distance of an agreement from any cut end: longer than every special token and every fixed pre-token.
MARGIN = 16
#: Characters from which on a pre-token has segments.
LONG = 64
#: Pre-tokens whose ids a worker remembers at once, and their characters.
REMEMBERED, REMEMBERED_CHARACTERS = 120_000, 1 << 21

# Below this code point no character composes with another or becomes several; above, the library does all the work.
_PLAIN_END = 0x180
_PLAIN = re.compile(f"[^\x00-įı-{chr(_PLAIN_END - 1)}]")


def _class(*categories: str) -> str:
    points = (chr(p) for p in range(_PLAIN_END) if unicodedata.category(chr(p))[0] in categories)
    return "".join(map(re.escape, points))


_BLANKS = "\t\n\x0b\x0c\r \x85\xa0"
# Fixed value: the tokenizer's pre-token pattern, with its classes spelled out for plain texts.
_PRE_TOKEN = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d|[{_class('L')}]+|[{_class('N')}]|[^{re.escape(_BLANKS)}{_class('L', 'N')}]+"
)


@dataclass
class Encoded:
    """Tokens of a stretch of text: each segment's start (in characters of the whole text) and end in ``ids``."""

    starts: np.ndarray
    ends: np.ndarray
    ids: np.ndarray

    def between(self, first: int, last: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, numbers of ids, and ids of the segments with numbers in [first, last)."""
        begin = int(self.ends[first - 1]) if first else 0
        ends = self.ends[first:last]
        return self.starts[first:last], np.diff(ends, prepend=begin), self.ids[begin:int(ends[-1]) if len(ends) else begin]


def _concatenated(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Encoded:
    starts, sizes, ids = (np.concatenate(x) for x in zip(*parts))
    return Encoded(starts, np.cumsum(sizes), ids)


class Codec:
    """A tokenizer file's encoder and decoder."""

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.specials = [x.content for x in self.whole.get_added_tokens_decoder().values()]
        self.by_word = Tokenizer.from_file(path)
        self.by_word.no_truncation()
        self.by_word.no_padding()
        self.by_word.normalizer = None
        self.by_word.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.strings = [self.whole.id_to_token(k) or "" for k in range(self.whole.get_vocab_size())]
        # a character of a token's string is a byte; the mark of a word's end is none
        self.widths = np.array([len(x.removesuffix(self.whole.model.end_of_word_suffix or "")) for x in self.strings])
        self.known: dict[str, bytes] = {}
        self.characters = 0

    def is_plain(self, text: str) -> bool:
        return (text.isascii() or not _PLAIN.search(text)) and not any(x in text for x in self.specials)

    def _learn(self, pre_tokens: list[str]) -> None:
        if len(self.known) > REMEMBERED or self.characters > REMEMBERED_CHARACTERS:
            self.known, self.characters = {}, 0
        new = list({x for x in pre_tokens if x not in self.known})
        self.characters += sum(map(len, new))
        if new:
            found = self.by_word.encode(new, is_pretokenized=True, add_special_tokens=False)
            ids = np.array(found.ids, dtype="<u4")
            ends = np.searchsorted(np.array(found.word_ids), np.arange(len(new)), side="right")
            data, at = ids.tobytes(), 0
            for word, end in zip(new, (4 * ends).tolist()):
                self.known[word] = data[at:end]
                at = end

    def _plain_ids(self, pre_tokens: list[str]) -> list[bytes]:
        try:
            return list(map(self.known.__getitem__, pre_tokens))
        except KeyError:
            self._learn(pre_tokens)
            return list(map(self.known.__getitem__, pre_tokens))

    def ids(self, text: str) -> np.ndarray:
        """The ids of a text by one pass over it."""
        if self.is_plain(text):
            return np.frombuffer(b"".join(self._plain_ids(_PRE_TOKEN.findall(text.lower()))), "<u4")
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _segments(self, word: str, ids: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Where the segments of a plain pre-token start, in its characters, and end, in its ids."""
        ends = np.cumsum(self.widths[np.frombuffer(ids, "<u4")])
        first_bytes = (np.frombuffer(word.encode(), np.uint8) & 0xC0) != 0x80
        if len(word) < LONG or ends[-1] != len(first_bytes):
            return np.zeros(1, np.int64), np.array([len(ends)], np.int64)
        whole = np.flatnonzero(first_bytes[ends[:-1]])
        return (
            np.concatenate(([0], (np.cumsum(first_bytes) - 1)[ends[whole]])).astype(np.int64),
            np.concatenate((whole + 1, [len(ends)])).astype(np.int64),
        )

    def spans(self, text: str, offset: int) -> Encoded:
        """A stretch of text by one pass, with its segments' places; ``offset`` is where the stretch starts."""
        if self.is_plain(text):
            matches = list(_PRE_TOKEN.finditer(text.lower()))
            parts = self._plain_ids([m.group() for m in matches])
            starts = np.array([m.start() + offset for m in matches], np.int64)
            sizes = np.array([len(x) // 4 for x in parts], np.int64)
            ends = np.cumsum(sizes)
            long = [k for k, m in enumerate(matches) if m.end() - m.start() >= LONG]
            if long:
                inner = [self._segments(matches[k].group(), parts[k]) for k in long]
                starts = np.sort(np.concatenate(
                    [np.delete(starts, long), *[x + starts[k] for k, (x, _) in zip(long, inner)]]
                ))
                ends = np.sort(np.concatenate(
                    [np.delete(ends, long), *[x + ends[k] - sizes[k] for k, (_, x) in zip(long, inner)]]
                ))
            return Encoded(starts, ends, np.frombuffer(b"".join(parts), "<u4"))
        found = self.whole.encode(text, add_special_tokens=False)
        # tokens of one pre-token share a word number; a special token has none
        words = np.array([-1 - k if w is None else w for k, w in enumerate(found.word_ids)], np.int64)
        starts, stops = np.array(found.offsets, np.int64).reshape(-1, 2).T
        new = np.concatenate(([True], words[1:] != words[:-1]))[:len(words)]
        first = np.flatnonzero(new)
        lengths = stops[np.concatenate((first[1:], [len(words)])) - 1] - starts[first] if len(words) else first
        long = np.repeat(lengths >= LONG, np.diff(np.concatenate((first, [len(words)]))))
        # a token that starts within a character starts before its forerunner's end
        clean = np.concatenate(([True], (starts[1:] >= stops[:-1]) & (starts[1:] > starts[:-1])))[:len(words)]
        first = np.flatnonzero(new | (long & clean))
        return Encoded(
            starts[first] + offset, np.concatenate((first[1:], [len(words)])) if len(words) else first,
            np.array(found.ids, dtype="<u4"),
        )

    def encode(self, text: str) -> np.ndarray:
        """The ids of a whole text, by tree concatenation beyond one leaf."""
        return self.ids(text) if len(text) <= LEAF else self.tree(text, 0, len(text)).ids

    def tree(self, text: str, start: int, end: int) -> Encoded:
        if end - start <= LEAF:
            return self.spans(text[start:end], start)
        middle = (start + end) // 2
        return self.join(text, self.tree(text, start, middle), self.tree(text, middle, end), start, middle, end)

    def join(self, text: str, left: Encoded, right: Encoded, start: int, middle: int, end: int) -> Encoded:
        """The tokens of text[start:end] from those of its two parts."""
        reach = REACH
        while True:
            low, high = max(start, middle - reach), min(end, middle + reach)
            window = self.spans(text[low:high], low)
            first = 0 if low == start else self._shared(text, window, left, low + MARGIN, middle - MARGIN)
            last = -1 if high == end else self._shared(text, window, right, middle + MARGIN, high - MARGIN)
            if first is not None and last is not None:
                before = np.searchsorted(left.starts, first) if low > start else 0
                after = np.searchsorted(right.starts, last) if high < end else len(right.starts)
                inner = (
                    np.searchsorted(window.starts, first) if low > start else 0,
                    np.searchsorted(window.starts, last) if high < end else len(window.starts),
                )
                return _concatenated(
                    [left.between(0, before), window.between(*inner), right.between(after, len(right.starts))]
                )
            reach *= 2

    @staticmethod
    def _shared(text: str, window: Encoded, side: Encoded, low: int, high: int) -> int | None:
        """A place in [low, high] where a segment ends and one starts in both, and no character composes with the one before."""
        near = side.starts[np.searchsorted(side.starts, low):np.searchsorted(side.starts, high, side="right")]
        for place in np.intersect1d(window.starts, near).tolist():
            at = [(x, int(np.searchsorted(x.starts, place))) for x in (window, side)]
            if min(k for _, k in at) == 0:
                continue
            (start, _, ids), (other, _, others) = (x.between(k - 1, k) for x, k in at)
            if start[0] != other[0] or not np.array_equal(ids, others):
                continue
            point = ord(text[place])
            if point < 0x300 or not (unicodedata.category(text[place])[0] == "M" or 0x1100 <= point < 0x1200):
                return place
        return None

    def decode(self, ids: np.ndarray) -> str:
        """What the library's decode gives for a tokenizer without a decoder: the tokens with blanks between."""
        return " ".join(map(self.strings.__getitem__, ids.tolist()))


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


Finish = Callable[[Codec, np.ndarray], tuple]


def _ids(_: Codec, ids: np.ndarray) -> tuple:
    return (ids.astype(np.int32).tolist(),)


def _digests(of: Codec, ids: np.ndarray) -> tuple:
    decoded = of.decode(ids).encode("utf-8", "replace")
    return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(decoded).hexdigest()


_IDS = ("ids array<int>", pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))]), _ids)
_DIGESTS = (
    "n_tokens long, ids_sha256 string, decoded_sha256 string",
    pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]),
    _digests,
)


def _text(raw: bytes) -> str:
    return raw.decode("utf-8", "replace")


def _encoded(docs: DataFrame, id_column: str, text_column: str, path: str, kind: tuple) -> DataFrame:
    columns, schema, finish = kind

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = codec(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):  # few texts' results at once
                part = batch.slice(at, 256)
                rows = [finish(of, of.encode(_text(raw))) for raw in part.column("text").to_pylist()]
                arrays = [pa.array(x, schema.field(k + 1).type) for k, x in enumerate(zip(*rows))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *arrays], schema=schema)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = codec(path)
        for batch in batches:
            found = [of.tree(text := _text(raw), 0, len(text)) for raw in batch.column("text").to_pylist()]
            arrays = [
                pa.array([getattr(x, name).astype(kind).tobytes() for x in found], pa.binary())
                for name, kind in (("starts", "<i4"), ("ends", "<i4"), ("ids", "<u4"))
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], [*batch.schema.names, "starts", "ends", "ids"])

    def joined(rows: pd.DataFrame) -> pd.DataFrame:
        of = codec(path)
        copies = int((rows["piece"] == 0).sum())  # rows that are equal in id and text have equal pieces
        rows = rows.drop_duplicates("piece").sort_values("piece")
        texts = [_text(raw) for raw in rows["text"]]
        text, bounds = "".join(texts), np.concatenate(([0], np.cumsum([len(x) for x in texts]))).tolist()
        parts = [
            Encoded(
                np.frombuffer(starts, "<i4").astype(np.int64) + offset, np.frombuffer(ends, "<i4").astype(np.int64),
                np.frombuffer(ids, "<u4"),
            ) for starts, ends, ids, offset in zip(rows["starts"], rows["ends"], rows["ids"], bounds)
        ]
        while len(parts) > 1:
            parts = [
                of.join(text, parts[k], parts[k + 1], *bounds[k:k + 3]) if k + 1 < len(parts) else parts[k]
                for k in range(0, len(parts), 2)
            ]
            bounds = [*bounds[:-1:2], bounds[-1]]
            # bounds has one more entry than parts
        row = (rows["doc_id"].iloc[0], *finish(of, parts[0].ids))
        return pd.DataFrame([row] * copies, columns=schema.names)

    texts = id_and_bytes(docs, id_column, text_column)
    decoded = F.col("text").cast("string")
    length = F.char_length(decoded)
    short = texts.where(length <= SPLIT).mapInArrow(whole, f"doc_id long, {columns}")
    number = F.sequence(F.lit(0), F.floor((length - 1) / SPLIT).cast("int"))
    split = (
        texts.where(length > SPLIT).withColumn("key", F.xxhash64("text"))
        .select("doc_id", "key", decoded.alias("whole"), F.explode(number).alias("piece"))
        .select("doc_id", "key", "piece", F.substring("whole", F.col("piece") * SPLIT + 1, F.lit(SPLIT)).cast("binary").alias("text"))
        .repartition("doc_id", "key", "piece")
    )
    encoded = split.mapInArrow(
        pieces, "doc_id long, key long, piece int, text binary, starts binary, ends binary, ids binary"
    )
    long = encoded.groupBy("doc_id", "key").applyInPandas(joined, f"doc_id long, {columns}")
    return short.union(long)


def encode(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", path: str | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id`` and ``ids``, as the tokenizer file at ``path`` gives for the whole text.

    A null or empty text has no ids. Special tokens' strings in a text become their ids. Repeated rows give repeated rows, an
    empty table an empty one. Other columns are ignored.
    """
    return _encoded(docs, id_column, text_column, path or public_tokenizers.path(TOKENIZER), _IDS)


def decode(tokens: DataFrame, id_column: str = "doc_id", ids_column: str = "ids", path: str | None = None) -> DataFrame:
    """``doc_id`` and ``text`` of rows with token ids; null ids decode like none, to an empty text."""
    path = path or public_tokenizers.path(TOKENIZER)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = codec(path)
        for batch in batches:
            found = [of.decode(np.array(ids or [], dtype=np.uint32)) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.string())], ["doc_id", "text"])

    chosen = tokens.select(F.col(id_column).cast("long").alias("doc_id"), F.col(ids_column).alias("ids"))
    return chosen.mapInArrow(texts, "doc_id long, text string")


def result(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_tokens``, and the SHA-256 of the ids and of what they decode to."""
    return _encoded(docs, "doc_id", "text", public_tokenizers.path(TOKENIZER), _DIGESTS)
