"""SentencePiece encoding and decoding of whole texts, by a table of each prefix's last token.

A model of merge type joins neighbouring symbols, the best-scored piece first and the leftmost of equals, until nothing joins.
What happens left of a boundary that is never joined across does not depend on the right side, so each prefix of a text has one
encoding, and a table of every prefix's last token holds them all. A token that ends at a place is the last one there if it is
compatible with the last token of the prefix before it: merging the two tokens' characters gives the two tokens back. An
automaton over the pieces lists the tokens that end at each place, longest first; exactly one is compatible, and a place where
none of two or more characters is has its single character. The ids are read off the table from the end backwards.

Where no piece of several characters can lie across a place (before a blank that follows another character, between letters and
punctuation, around control characters), the text is cut, and parts that come again are taken from a bounded memory.
"""

from __future__ import annotations

import codecs
import hashlib
import re
import string
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclake.llm.common import id_and_bytes

MODEL = "piece_bpe_32k.model"
BLANK = "▁"
#: Parts and pairs of tokens whose answers a worker remembers at once, and the longest part of them in characters.
REMEMBERED = 100_000
LONGEST_REMEMBERED = 48
#: Texts whose results are held at once.
SLICE = 256
#: Below every piece's score.
NEVER = float("-inf")
LETTERS = string.ascii_letters + "".join(chr(k) for k in range(0xC0, 0x100) if chr(k).isalpha())
#: In place of a token before the first one.
START = -1


class Pieces:
    """The pieces of a model file: which joins they allow, their bytes, and the codes of texts."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        if model.normalize("  a\tbéﬁ ") != f"{BLANK}  a\tbéﬁ ".replace(" ", BLANK):
            raise ValueError("only models that leave a text as it is, but for one blank before it, are known here")
        count = model.vocab_size()
        self.end, self.unknown = model.eos_id(), model.unk_id()
        self.names = [model.id_to_piece(k) for k in range(count)]
        self.lengths = list(map(len, self.names))
        self.bytes: list[bytes] = []
        self.score: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.octets: dict[int, int] = {}
        byte_ids = [0] * 256
        for k, piece in enumerate(self.names):
            if model.is_byte(k):
                byte_ids[int(piece[1:-1], 16)] = k
                self.octets[k] = int(piece[1:-1], 16)
                self.bytes.append(bytes([self.octets[k]]))
            elif model.is_control(k):
                self.bytes.append(b"")
            elif k == self.unknown:
                self.bytes.append(" ⁇ ".encode())
            else:
                self.ids[piece], self.score[piece] = k, model.get_score(k)
                self.bytes.append(piece.replace(BLANK, " ").encode())
        self.byte_ids = byte_ids
        joins = [piece for piece in self.ids if len(piece) > 1]
        self._automaton({piece: self.ids[piece] for piece in joins})
        neighbours = {piece[k:k + 2] for piece in joins for k in range(len(piece) - 1)}
        inside = {c for pair in neighbours for c in pair}
        alone = re.escape("".join(chr(k) for k in range(128) if chr(k) not in inside and k != 32))
        stops = re.escape("".join(c for c in string.punctuation if not any(x + c in neighbours for x in LETTERS)))
        if any(pair[1] == BLANK != pair[0] for pair in neighbours):
            self.parts = re.compile(f"[{alone}]|[^{alone}]+")
        else:
            self.parts = re.compile(
                f"{BLANK}*[{LETTERS}]++(?=[{BLANK}{alone}{stops}]|$)|{BLANK}+[^{BLANK}{alone}]*|[^{BLANK}{alone}]+|[{alone}]"
            )
        self._parts_ids: dict[str, tuple[int, ...]] = {}
        self._older_ids: dict[str, tuple[int, ...]] = {}
        self._fits: dict[int, bool] = {}
        self._histories: dict[str, tuple | None] = {}

    def _automaton(self, words: dict[str, int]) -> None:
        """States are prefixes of words, 0 the empty one. ``steps``: by character to the longest prefix that ends the text so
        far; ``ending``: the words that end there as (length, id), longest first; ``falls``: the next shorter prefix."""
        self.steps: list[dict[str, int]] = [{}]
        self.ending: list[tuple[tuple[int, int], ...]] = [()]
        for word, token in words.items():
            state = 0
            for c in word:
                if c not in self.steps[state]:
                    self.steps[state][c] = len(self.steps)
                    self.steps.append({})
                    self.ending.append(())
                state = self.steps[state][c]
            self.ending[state] = ((len(word), token),)
        self.falls = [0] * len(self.steps)
        todo = deque(self.steps[0].values())
        while todo:
            state = todo.popleft()
            for c, child in self.steps[state].items():
                fall = self.falls[state]
                while fall and c not in self.steps[fall]:
                    fall = self.falls[fall]
                self.falls[child] = self.steps[fall].get(c, 0)
                self.ending[child] += self.ending[self.falls[child]]
                todo.append(child)
        self.learnt = 0

    def _step(self, state: int, c: str) -> int:
        """The step on a character that no longer prefix goes on with; kept for the next time."""
        fall = self.falls[state]
        while fall and c not in self.steps[fall]:
            fall = self.falls[fall]
        found = self.steps[fall].get(c, 0)
        if self.learnt < REMEMBERED and state:
            self.learnt += 1
            self.steps[state][c] = found
        return found

    def merged(self, text: str) -> list[tuple[float, list[str]]]:
        """A short text's symbols before each join with the score of that join, and after the last one: best score first,
        leftmost of equals."""
        parts, score, steps = list(text), self.score, []
        while True:
            best, at = NEVER, -1
            for k in range(len(parts) - 1):
                value = score.get(parts[k] + parts[k + 1], NEVER)
                if value > best:
                    best, at = value, k
            steps.append((best, list(parts)))
            if at < 0:
                return steps
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def _history(self, token: str) -> tuple[list[float], list[str], list[str]] | None:
        """Scores of a token's joins, and its first and last symbol before each; None if its characters give other tokens."""
        if token not in self._histories:
            steps = self.merged(token)
            whole = steps[-1][1] == [token]
            self._histories[token] = ([x for x, _ in steps], [x[0] for _, x in steps], [x[-1] for _, x in steps]) if whole else None
        return self._histories[token]

    def _compatible(self, left: str, token: str) -> bool:
        """Both tokens' joins run side by side; the pair holds if no join across the boundary is ever the best one."""
        a, b = self._history(left), self._history(token)
        if not a or not b:
            return False
        (scores_a, _, edges_a), (scores_b, edges_b, _) = a, b
        i = j = 0
        while True:
            across = self.score.get(edges_a[i] + edges_b[j])
            if across is not None and across > scores_a[i] and across >= scores_b[j]:
                return False
            if scores_a[i] == scores_b[j] == NEVER:
                return True
            if scores_a[i] >= scores_b[j]:
                i += 1
            else:
                j += 1

    def fits(self, left: int, token: int) -> bool:
        """Whether a token can follow another (the negative START, at a text's start): their characters merge to just the two."""
        name = self.names[token]
        known = self._compatible(self.name(left), name) if left >= 0 else self._history(name) is not None
        if len(self._fits) >= REMEMBERED:
            self._fits.clear()
        self._fits[left << 24 | token] = known
        return known

    def name(self, token: int) -> str:
        """A token's characters; numbers from the vocabulary's size on are characters without a piece."""
        return self.names[token] if token < len(self.names) else chr(token - len(self.names))

    def table(self, text: str) -> list[int]:
        """For each prefix of ``text``, by its length, its last token; START for the empty one."""
        single, extra, last, state = self.ids, len(self.names), [START], 0
        steps, ending, known = self.steps, self.ending, self._fits.get
        for end, c in enumerate(text, 1):
            following = steps[state].get(c)
            state = self._step(state, c) if following is None else following
            for length, token in ending[state]:
                left = last[end - length]
                fits = known(left << 24 | token)
                if fits or fits is None and self.fits(left, token):
                    last.append(token)
                    break
            else:
                last.append(single[c] if c in single else extra + ord(c))
        return last

    def _part(self, part: str) -> tuple[int, ...]:
        """The ids of a part, read off its table backwards; characters without a piece as their bytes."""
        if known := self._older_ids.get(part):
            self._remember(part, known)
            return known
        last, ids, end, extra, lengths = self.table(part), [], len(part), len(self.names), self.lengths
        while end:
            token = last[end]
            if token < extra:
                ids.append(token)
                end -= lengths[token]
            else:
                ids.extend(self.byte_ids[octet] for octet in reversed(chr(token - extra).encode()))
                end -= 1
        ids.reverse()
        found = tuple(ids)
        if len(part) <= LONGEST_REMEMBERED:
            self._remember(part, found)
        return found

    def _remember(self, part: str, ids: tuple[int, ...]) -> None:
        """Parts seen since the memory was last full, and those of the time before it."""
        if len(self._parts_ids) >= REMEMBERED:
            self._parts_ids, self._older_ids = {}, self._parts_ids
        self._parts_ids[part] = ids

    def encode(self, text: str) -> list[int]:
        """The ids of a whole text, with the end id last."""
        ids: list[int] = []
        if text:
            for part in self.parts.findall(BLANK + text.replace(" ", BLANK)):
                ids.extend(self._parts_ids.get(part) or self._part(part))
        ids.append(self.end)
        return ids

    def decode(self, ids: list[int]) -> str:
        """The text of ids: pieces joined, the blank before the text left out, broken bytes as U+FFFD each."""
        raw = b"".join(map(self.bytes.__getitem__, ids))
        # the blank to drop is a piece's, so it comes first among what is not a control piece
        first = next((k for k in ids if self.bytes[k]), None)
        if first is not None and first not in self.octets and first != self.unknown and raw.startswith(b" "):
            raw = raw[1:]
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return raw.decode(errors="sentence_piece_bytes")


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("sentence_piece_bytes", _each_byte)

_loaded: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """The model at ``path``, loaded once per worker; another path takes its place."""
    if path not in _loaded:
        _loaded.clear()
        _loaded[path] = Pieces(path)
    return _loaded[path]


def encode(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", path: str | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id`` and ``ids``, as the model file at ``path`` gives for the whole text, end id last.

    A null or empty text has the end id alone. Strings of control pieces in a text are plain text. Repeated rows give repeated
    rows, an empty table an empty one. Other columns are ignored. A task holds one text and its ids at once.
    """
    path = path or public_tokenizers.path(MODEL)

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = pieces(path)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                found = pa.array((of.encode(raw.as_py().decode()) for raw in part.column("text")), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), found], ["doc_id", "ids"])

    return id_and_bytes(docs, id_column, text_column).mapInArrow(ids, "doc_id long, ids array<int>")


def decode(tokens: DataFrame, id_column: str = "doc_id", ids_column: str = "ids", path: str | None = None) -> DataFrame:
    """``doc_id`` and ``text`` of rows with ids; null ids decode like none, to an empty text. An id out of range is an error."""
    path = path or public_tokenizers.path(MODEL)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = pieces(path)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                found = pa.array((of.decode(ids.as_py() or []) for ids in part.column("ids")), pa.string())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), found], ["doc_id", "text"])

    chosen = tokens.select(F.col(id_column).cast("long").alias("doc_id"), F.col(ids_column).alias("ids"))
    return chosen.mapInArrow(texts, "doc_id long, text string")


def result(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id``, ``n_tokens``, and the SHA-256 of the ids and of what they decode to; rows as in ``encode``."""
    path = path or public_tokenizers.path(MODEL)
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()),
    ])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = pieces(path)
        names = [str(k) for k in range(len(of.bytes))]
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part, rows = batch.slice(at, SLICE), []
                for raw in part.column("text"):
                    ids = of.encode(raw.as_py().decode())
                    listed = " ".join(map(names.__getitem__, ids)).encode()
                    text = of.decode(ids).encode()
                    rows.append((len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(text).hexdigest()))
                arrays = [pa.array(x, schema.field(k + 1).type) for k, x in enumerate(zip(*rows))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *arrays], schema=schema)

    kind = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return id_and_bytes(docs, "doc_id", "text").mapInArrow(digests, kind)
