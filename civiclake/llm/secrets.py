"""Secrets in texts: rules that always hold, and a character network that adds what the rules miss.

Candidates are all runs of key characters as long as the rules' shortest value. A small convolutional network in numpy reads
each candidate with the text around it. It is trained on the rules' findings (labelled secrets) against candidates that hold
none, up to a bounded number of each. Its threshold is the highest that keeps the recall asked for over all labelled secrets that
it hasn't seen, however many there are.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civiclake.llm.common import id_and_bytes, stored

KINDS = ("assign", "access", "hex", "network")

# The rules. Bytes that aren't ASCII are in no class, so matching UTF-8 bytes is matching code points.
_ASSIGN = re.compile(
    rb"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_LEAST_VALUE = 6
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_LEAST_ACCESS = 20
_HEX = re.compile(rb"[0-9a-f]+")
_LEAST_HEX = 24

#: Candidates: runs of key characters at least so long, which is the shortest value that the rules count.
LEAST_RUN = _LEAST_VALUE
_RUN = re.compile(rb"[A-Za-z0-9+/_.=-]{%d,}" % LEAST_RUN)
_RULE_RUN = re.compile(rb"[A-Za-z0-9+/_.=-]{%d,}" % min(_LEAST_ACCESS, _LEAST_HEX))
#: Values from this length on are sampled apart from shorter ones, which are nearly all words.
LONG = 16

#: Bytes the network reads: of a candidate, and on either side. Longer candidates are read in several overlapping windows.
VALUE = 48
AROUND = 16
WINDOW = VALUE + 2 * AROUND
STEP = VALUE // 2
#: At most so many labelled rows per class, of short and of long values each, are learned from, the first by a hash of their content.
#: The threshold comes from all labelled secrets.
SAMPLE = 1500
#: Distinct secrets that a task holds before it sends them on.
HELD = 1 << 16
RECALL = 0.99
#: Bytes of text that are screened at once, and the error in a logit that single precision is allowed.
BLOCK = 1 << 15
SINGLE = 0.01
FILTERS = 24
WIDTH = 5
EMBEDDING = 8
EPOCHS = 12
SEED = 11


def _symbol_table() -> np.ndarray:
    """Byte to input symbol: digits and letters each their own, other key characters, blanks, quotes, the rest. 0: nothing."""
    table = np.full(256, 1, dtype=np.int64)
    for k, letter in enumerate(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_.=-\"':;,@ \n"):
        table[letter] = k + 2
    table[0] = 0
    return table


_SYMBOLS = _symbol_table()
_SYMBOL_COUNT = int(_SYMBOLS.max()) + 1


def rule_spans(text: bytes) -> list[tuple[int, int, int]]:
    """What the rules find: (start, index in KINDS, end) in bytes, unsorted."""
    found = []
    lowered = text.lower()
    if any(word in lowered for word in _ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= _LEAST_VALUE]
    for run in _RULE_RUN.finditer(text):
        if run.end() - run.start() >= _LEAST_ACCESS:
            for kind, rule, least in ((1, _ACCESS, _LEAST_ACCESS), (2, _HEX, _LEAST_HEX)):
                found += [
                    (m.start(), kind, m.end()) for m in rule.finditer(text, run.start(), run.end())
                    if m.end() - m.start() >= least
                ]
    return found


def value_spans(text: bytes) -> list[tuple[int, int, int]]:
    """The rules' spans without the words that announce them: a name isn't a secret."""
    lowered = text.lower()
    named = any(word in lowered for word in _ASSIGN_WORDS)
    values = [(m.start(2), 0, m.end(2)) for m in _ASSIGN.finditer(text) if len(m[2]) >= _LEAST_VALUE] if named else []
    return values + [span for span in rule_spans(text) if span[1]]


def candidates(text: bytes) -> list[tuple[int, int]]:
    return [run.span() for run in _RUN.finditer(text)]


def _window(text: bytes, start: int, end: int) -> bytes:
    """A fixed number of bytes: those before, the value padded with zeros, those after."""
    before = text[max(0, start - AROUND):start].rjust(AROUND, b"\0")
    return before + text[start:end].ljust(VALUE, b"\0") + text[end:end + AROUND].ljust(AROUND, b"\0")


def _window_starts(start: int, end: int) -> range:
    return range(start, max(start + 1, end - STEP), STEP)


def windows(text: bytes, start: int, end: int) -> list[bytes]:
    """The windows that together cover a candidate."""
    return [_window(text, at, min(end, at + VALUE)) for at in _window_starts(start, end)]


@dataclass
class Network:
    """Embedding, one convolution, maximum and mean over places, one output; then Platt's scale and a threshold."""

    embedding: np.ndarray
    kernel: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    scale: tuple[float, float] = (1.0, 0.0)
    threshold: float = 2.0
    least: float = np.inf
    recall: float = 0.0
    held: int = 0
    _tables: tuple | None = None

    def _forward(self, inputs: np.ndarray):
        embedded = self.embedding[inputs]
        patches = np.lib.stride_tricks.sliding_window_view(embedded, WIDTH, axis=1)  # rows, places, channels, width
        patches = patches.reshape(*patches.shape[:2], -1)
        hidden = np.maximum(patches @ self.kernel + self.bias, 0)
        pooled = np.concatenate((hidden.max(axis=1), hidden.mean(axis=1)), axis=1)
        # summed row by row: a window's logit is the same to the last bit, whatever windows it is read with
        return embedded, patches, hidden, pooled, (pooled * self.out).sum(axis=1) + self.out_bias

    def logits(self, contents: list[bytes]) -> np.ndarray:
        found = [
            self._forward(_SYMBOLS[np.frombuffer(b"".join(contents[k:k + 256]), np.uint8)].reshape(-1, WINDOW))[-1]
            for k in range(0, len(contents), 256)
        ]
        return np.concatenate(found) if found else np.zeros(0)

    def _pair_tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What the convolution adds for two neighbouring symbols, twice, and for the last one; a row per pair or symbol."""
        if self._tables is None:
            kernel = self.kernel.reshape(EMBEDDING, WIDTH, FILTERS)
            one = [(self.embedding @ kernel[:, k]).astype(np.float32) for k in range(WIDTH)]
            pairs = [(one[k][:, None] + one[k + 1]).reshape(-1, FILTERS) for k in (0, 2)]
            self._tables = pairs[0], pairs[1], one[4] + self.bias.astype(np.float32)
        return self._tables

    def _hidden(self, symbols: np.ndarray) -> np.ndarray:
        """The convolution's places over the last axis of symbols."""
        first, second, last = self._pair_tables()
        pairs = symbols[..., :-1] * _SYMBOL_COUNT + symbols[..., 1:]
        found = first.take(pairs[..., :-3], axis=0)
        found += second.take(pairs[..., 2:-1], axis=0)
        found += last.take(symbols[..., 4:], axis=0)
        return np.maximum(found, 0, out=found)

    def screened(self, text: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Whether a candidate may reach the threshold: its logit in single precision, or true for the longest.

        The convolution is worked out once for the text, and only where a window has other neighbours than the text has, again.
        """
        maybe = np.ones(len(starts), dtype=bool)
        mean_out, empty = self.out[FILTERS:].astype(np.float32), self._hidden(np.zeros(WIDTH, dtype=np.int64))
        short = np.flatnonzero(ends - starts <= VALUE - WIDTH + 1)
        for block in np.split(short, np.flatnonzero(np.diff(starts[short] // BLOCK)) + 1):
            if not len(block):
                continue
            low, high = starts[block[0]] - AROUND, ends[block[-1]] + AROUND
            padded = text[max(0, low):high].rjust(min(high, len(text)) - low, b"\0") + bytes(max(0, high - len(text)))
            symbols = _SYMBOLS[np.frombuffer(padded, np.uint8)]
            start, end = starts[block] - low, ends[block] - low
            # places of the value's end before nothing, and of nothing before what follows
            edge = np.zeros((len(block), 2, 2 * WIDTH - 2), dtype=np.int64)
            back = end[:, None] + np.arange(1 - WIDTH, 0)
            edge[:, 0, :WIDTH - 1], edge[:, 1, WIDTH - 1:] = symbols[back], symbols[end[:, None] + np.arange(WIDTH - 1)]
            edge = self._hidden(edge).reshape(len(block), -1, FILTERS)
            hidden = self._hidden(symbols)
            by_mean = np.concatenate(([0.0], np.cumsum(hidden @ mean_out, dtype=np.float64)))
            summed = by_mean[end - WIDTH + 1] - by_mean[start - AROUND]
            summed += by_mean[end + AROUND - WIDTH + 1] - by_mean[end] + (edge @ mean_out).sum(axis=1)
            empties = VALUE - (end - start) - WIDTH + 1
            summed += empties * (empty @ mean_out)
            most = np.maximum(edge.max(axis=1), np.where(empties[:, None] > 0, empty, 0))
            for wide in (1, 2, 4):  # each row: the maximum over the next places, in the end eight
                hidden = np.maximum(hidden[:-wide], hidden[wide:])
            for at in (end, end + AROUND - WIDTH - 7):
                np.maximum(most, hidden.take(at, axis=0), out=most)
            hidden = np.maximum(hidden[:-8], hidden[8:])
            last = end - WIDTH - 15
            for step in range(0, VALUE + AROUND, 16):
                more = np.flatnonzero(start - AROUND + step < last + 16)
                at = np.minimum(start[more] - AROUND + step, last[more])
                if len(more) == len(block):
                    np.maximum(most, hidden.take(at, axis=0), out=most)
                elif len(more):
                    most[more] = np.maximum(most[more], hidden.take(at, axis=0))
            maybe[block] = most @ self.out[:FILTERS] + summed / (WINDOW - WIDTH + 1) + self.out_bias >= self.least - SINGLE
        return maybe

    def probabilities(self, contents: list[bytes]) -> np.ndarray:
        return self._scaled(self.logits(contents))

    def _scaled(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale[0] * logits + self.scale[1], -50, 50)))

    def judged_from(self, least: float, below: int, held: int) -> None:
        """Set the threshold to that logit, which so many of the held secrets don't reach."""
        self.least, self.threshold = least, float(self._scaled(np.array([least]))[0])
        self.recall, self.held = 1 - below / held, held


def _trained(inputs: np.ndarray, labels: np.ndarray, rng: np.random.Generator) -> Network:
    net = Network(
        rng.normal(0, 0.3, (_SYMBOL_COUNT, EMBEDDING)), rng.normal(0, 0.2, (WIDTH * EMBEDDING, FILTERS)), np.zeros(FILTERS),
        rng.normal(0, 0.2, 2 * FILTERS), 0.0,
    )
    names = ("embedding", "kernel", "bias", "out", "out_bias")
    first, second, step = {n: 0.0 for n in names}, {n: 0.0 for n in names}, 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), 64):
            rows = order[at:at + 64]
            embedded, patches, hidden, pooled, logits = net._forward(inputs[rows])
            error = (1 / (1 + np.exp(-np.clip(logits, -50, 50))) - labels[rows]) / len(rows)
            to_pooled = error[:, None] * net.out
            to_hidden = np.repeat(to_pooled[:, None, FILTERS:] / hidden.shape[1], hidden.shape[1], axis=1)
            best = hidden.argmax(axis=1)
            np.put_along_axis(
                to_hidden, best[:, None, :],
                np.take_along_axis(to_hidden, best[:, None, :], axis=1) + to_pooled[:, None, :FILTERS], axis=1,
            )
            to_hidden *= hidden > 0
            flat = to_hidden.reshape(-1, FILTERS)
            to_patches = (flat @ net.kernel.T).reshape(*hidden.shape[:2], EMBEDDING, WIDTH)
            to_embedded = np.zeros_like(embedded)
            for k in range(WIDTH):
                to_embedded[:, k:k + hidden.shape[1]] += to_patches[..., k]
            to_embedding = np.zeros_like(net.embedding)
            np.add.at(to_embedding, inputs[rows], to_embedded)
            slopes = {
                "embedding": to_embedding, "kernel": patches.reshape(-1, WIDTH * EMBEDDING).T @ flat, "bias": flat.sum(axis=0),
                "out": pooled.T @ error, "out_bias": error.sum(),
            }
            step += 1
            for name, slope in slopes.items():  # Adam
                first[name] = 0.9 * first[name] + 0.1 * slope
                second[name] = 0.999 * second[name] + 0.001 * slope**2
                change = 0.01 * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
                setattr(net, name, getattr(net, name) - change)
    return net


_LETTERS = np.frombuffer(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_-", np.uint8)


def _replaced(row: bytes, others: list[bytes], rng: np.random.Generator) -> bytes:
    """A secret's window with random key characters, a digit among them, as many or fewer, in another row's surroundings."""
    size = len(row[AROUND:AROUND + VALUE].rstrip(b"\0"))
    if size > LEAST_RUN and rng.random() < 0.5:
        size = int(rng.integers(LEAST_RUN, size))
    around = others[rng.integers(len(others))]
    value = rng.choice(_LETTERS, size)
    value[rng.integers(size)] = rng.choice(_LETTERS[:10])
    value = value.tobytes().ljust(VALUE, b"\0")
    return around[:AROUND] + value + around[AROUND + VALUE:]


def _learned(secret: list[bytes], plain: list[bytes]) -> tuple[Network, np.ndarray, list[bytes], int] | None:
    """A network without a threshold, the logits of the secrets held back, the plain rows held back, and how often each secret
    is also shown replaced; None if one class has under four rows."""
    secret, plain = (sorted(set(rows), key=lambda row: hashlib.blake2b(row).digest()) for rows in (secret, plain))
    if min(len(secret), len(plain)) < 4:
        return None
    rng = np.random.default_rng(SEED)
    times = max(1, len(plain) // len(secret))
    shown, secrets = (
        [*secret[k::2], *(_replaced(row, plain[k::2], rng) for row in secret[k::2] * times)] for k in (0, 1)
    )
    rows = shown + plain[::2] + [row.upper() for row in plain[::2]]
    inputs = _SYMBOLS[np.frombuffer(b"".join(rows), np.uint8)].reshape(-1, WINDOW)
    net = _trained(inputs, np.repeat((1.0, 0.0), (len(shown), len(rows) - len(shown))), rng)
    held = secrets + plain[1::2]
    truth = np.repeat((1.0, 0.0), (len(secrets), len(plain[1::2])))
    logits, a, b = net.logits(held), 1.0, 0.0
    for _ in range(200):  # Platt: a logistic fit of the held logits, with smoothed targets
        smooth = np.where(truth > 0, (truth.sum() + 1) / (truth.sum() + 2), 1 / ((1 - truth).sum() + 2))
        error = 1 / (1 + np.exp(-np.clip(a * logits + b, -50, 50))) - smooth
        a, b = a - 0.05 * (error * logits).mean(), b - 0.05 * error.mean()
    net.scale = (max(a, 1e-3), b)
    return net, logits[:len(secrets)], plain[1::2], times


def train(secret: list[bytes], plain: list[bytes], recall: float = RECALL) -> Network | None:
    """A network from labelled windows, or None if one class has under four rows.

    Half of the rows, every other one by a hash, are for calibration alone. In both halves each secret is also shown with its
    value replaced by random key characters, a digit among them, as many or fewer, in a plain row's surroundings, so
    that neither the network nor the threshold fits one spelling, length or announcement of secrets; more than once, if secrets
    are fewer than plain rows. Plain rows are also shown in capitals.
    """
    learned = _learned(secret, plain)
    if learned is None:
        return None
    net, logits = learned[0], np.sort(learned[1])
    least = logits[int(np.floor((1 - recall) * len(logits)))]
    net.judged_from(float(least), int((logits < least).sum()), len(logits))
    return net


def _overlapping(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int, int]]) -> np.ndarray:
    if not spans:
        return np.zeros(len(starts), dtype=bool)
    spans = sorted(spans)
    last = np.maximum.accumulate([span[2] for span in spans])
    before = np.searchsorted([span[0] for span in spans], ends)
    return (before > 0) & (last[before - 1] > starts)


_HASH = np.random.default_rng(3).integers(1 << 62, 1 << 63, size=WINDOW // 8, dtype=np.uint64) | np.uint64(1)


def _window_rows(text: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """What _window gives for each pair of places, as a row of bytes."""
    padded = np.frombuffer(bytes(AROUND) + text + bytes(VALUE + AROUND), np.uint8)
    wide = np.lib.stride_tricks.sliding_window_view(padded, AROUND + VALUE)[starts]
    wide[np.arange(AROUND + VALUE) >= (AROUND + ends - starts)[:, None]] = 0
    return np.concatenate((wide, np.lib.stride_tricks.sliding_window_view(padded, AROUND)[ends + AROUND]), axis=1)


def _hashes(rows: np.ndarray) -> np.ndarray:
    found = (rows.view(np.uint64) * _HASH).sum(axis=1, dtype=np.uint64)
    found ^= found >> np.uint64(32)
    found *= _HASH[0]
    return (found >> np.uint64(1)).astype(np.int64)


def _shown(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and label of what is learned from a text: each window of each candidate, with its own label."""
    places = [
        (at, min(end, at + VALUE)) for start, end in candidates(text) for at in _window_starts(start, end)
    ]
    starts, ends = np.array(places, dtype=np.int64).reshape(-1, 2).T
    return starts, ends, _overlapping(starts, ends, value_spans(text))


def _labelled(sample: int):
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A task's distinct windows: all secrets, some more than once, and of the plain ones the first by hash of each length,
        which are all that can be among the first of all tasks."""
        kept: dict[int, dict[bytes, int]] = {kind: {} for kind in range(2)}
        limit = dict.fromkeys(kept, 1 << 63)
        secrets: dict[bytes, tuple[int, int]] = {}
        for batch in batches:
            for text in batch.column("text").to_pylist():
                starts, ends, labels = _shown(text)
                kinds = 2 * labels + (ends - starts >= LONG)
                for at in range(0, len(starts), 4096):
                    rows = _window_rows(text, starts[at:at + 4096], ends[at:at + 4096])
                    hashes, of = _hashes(rows), kinds[at:at + 4096]
                    for kind, held in kept.items():
                        for k in np.flatnonzero((of == kind) & (hashes < limit[kind])):
                            held[rows[k].tobytes()] = int(hashes[k])
                        if len(held) > 2 * sample:
                            held = kept[kind] = dict(sorted(held.items(), key=lambda x: (x[1], x[0]))[:sample])
                            limit[kind] = max(held.values()) + 1
                    for k in np.flatnonzero(of >= 2):
                        secrets[rows[k].tobytes()] = int(of[k]), int(hashes[k])
                    if len(secrets) >= HELD:
                        yield _sent((kind, found, content) for content, (kind, found) in secrets.items())
                        secrets = {}
        yield _sent((kind, found, content) for content, (kind, found) in secrets.items())
        for kind, held in kept.items():
            yield _sent((kind, found, content) for content, found in sorted(held.items(), key=lambda x: (x[1], x[0]))[:sample])

    return first


def _sent(rows) -> pa.RecordBatch:
    kinds, hashes, contents = zip(*rows) if (rows := list(rows)) else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(kinds, pa.int32()), pa.array(hashes, pa.int64()), pa.array(contents, pa.binary())], ["kind", "hash", "content"]
    )


def _places(logits: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the logits."""
    bits = (logits + 0.0).view(np.int64)
    return bits ^ ((bits >> 63) & np.int64((1 << 63) - 1))


def _logit_at(place: int) -> float:
    return float(np.array([place ^ ((place >> 63) & ((1 << 63) - 1))], dtype=np.int64).view(np.float64)[0])


def _judged(secrets: DataFrame, network: Network, others: list[bytes], times: int) -> DataFrame:
    """The place of each secret's logit and, as in training, of those of its replacements, which depend on its content alone."""
    sent = secrets.sparkSession.sparkContext.broadcast((network, others))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, others = sent.value
        for batch in batches:
            shown = []
            for content in batch.column("content").to_pylist():
                rng = np.random.default_rng(list(hashlib.blake2b(content).digest()))
                shown += [content, *(_replaced(content, others, rng) for _ in range(times))]
            yield pa.RecordBatch.from_arrays([pa.array(_places(network.logits(shown)), pa.int64())], ["place"])

    return secrets.select("content").mapInArrow(judged, "place long")


def _at_share(places: DataFrame, own: np.ndarray, share: float) -> tuple[int, int, int]:
    """Of ``places`` and ``own`` together in ascending order: the one that many of them, ``share`` of all, come before; how many
    are less; how many there are. Exact, by 16 bits at a time, so that at most 65,536 counts come to the driver at once."""
    less, total, rank, prefix = 0, 0, 0, None
    for shift in (48, 32, 16, 0):
        if prefix is not None:
            places = places.where(F.shiftright("place", shift + 16) == prefix)
            own = own[own >> (shift + 16) == prefix]
        counts = {row["at"]: row["rows"] for row in places.groupBy(F.shiftright("place", shift).alias("at"))
                  .agg(F.count(F.lit(1)).alias("rows")).collect()}
        for at, rows in zip(*np.unique(own >> shift, return_counts=True)):
            counts[int(at)] = counts.get(int(at), 0) + int(rows)
        if prefix is None:
            total = sum(counts.values())
            rank = int(np.floor(share * total))
        for prefix in sorted(counts):
            if less + counts[prefix] > rank:
                break
            less += counts[prefix]
    return prefix, less, total


def fit(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", sample: int = SAMPLE, recall: float = RECALL
) -> Network | None:
    """A network trained on up to ``sample`` distinct labelled candidates per class out of all of ``docs``.

    Short and long values are classes of their own. Each task sends the first of its plain windows by hash, and all secrets: the
    threshold is set on every distinct one in ``docs`` that the network was not trained on.
    """
    found = id_and_bytes(docs, id_column, text_column).mapInArrow(_labelled(sample), "kind int, hash long, content binary")
    found = stored(found, "secrets").distinct()
    rows = [
        [bytes(row["content"]) for row in found.where(F.col("kind") == kind).orderBy("hash", "content").limit(sample).collect()]
        for kind in range(4)
    ]
    if max(len(rows[2]), len(rows[3])) < sample:
        return train(rows[2] + rows[3], rows[0] + rows[1], recall)
    learned = _learned(rows[2] + rows[3], rows[0] + rows[1])
    if learned is None:
        return None
    network, logits, others, times = learned
    drawn = docs.sparkSession.createDataFrame([(content,) for content in rows[2] + rows[3]], "content binary")
    rest = found.where(F.col("kind") >= 2).join(F.broadcast(drawn), "content", "left_anti")
    places = stored(_judged(rest, network, others, times), "secret-places")
    place, less, total = _at_share(places, _places(logits), 1 - recall)
    network.judged_from(_logit_at(place), less, total)
    return network


def find(text: bytes, network: Network | None) -> list[tuple[int, int, int]]:
    """All spans of a text, (start, index in KINDS, end) in bytes, sorted. Added spans never overlap those of the rules."""
    spans = rule_spans(text)
    added = []
    if network:
        places = np.array(candidates(text), dtype=np.int64).reshape(-1, 2)
        places = places[~_overlapping(places[:, 0], places[:, 1], spans)]
        open_runs = places[network.screened(text, places[:, 0], places[:, 1])].tolist()
        read = [windows(text, *run) for run in open_runs]
        scores = network.probabilities([content for of in read for content in of])
        at = 0
        for run, of in zip(open_runs, read):
            if scores[at:at + len(of)].max() >= network.threshold:
                added.append((run[0], 3, run[1]))
            at += len(of)
    return sorted(spans + added)


def _in_code_points(text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    if not spans or text.isascii():
        return spans
    before = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
    return [(int(before[start]), kind, int(before[end])) for start, kind, end in spans]


SPANS = "doc_id long, spans array<struct<kind: string, start: long, end: long>>"


def scan(docs: DataFrame, network: Network | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id`` and ``spans`` (kind, start, end; code points, end exclusive) by start and kind.

    Whole texts are read; a null or empty text has no spans. Spans of the rules are always there. Without a network (None),
    there are no others. Repeated rows give repeated rows. Other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(network)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = sent.value
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            spans = [
                [{"kind": KINDS[k], "start": start, "end": end} for start, k, end in _in_code_points(text, find(text, network))]
                for text in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, kind)], ["doc_id", "spans"])

    return id_and_bytes(docs, id_column, text_column).mapInArrow(found, SPANS)


MASK = b"[SECRET]"


def redact(docs: DataFrame, network: Network | None, text_column: str = "text", mask: bytes = MASK) -> DataFrame:
    """``docs`` with each secret in the text replaced; overlapping spans become one mask. Null texts stay null."""
    sent = docs.sparkSession.sparkContext.broadcast(network)

    def masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = sent.value
        for batch in batches:
            place = batch.schema.get_field_index(text_column)
            texts = []
            for text in batch.column(place).to_pylist():
                spans = find(raw, network) if text is not None and (raw := text.encode("utf-8", "replace")) else []
                if spans:
                    parts, at = [], 0
                    for start, _, end in spans:
                        if start >= at:
                            parts += [raw[at:start], mask]
                        at = max(at, end)
                    text = b"".join((*parts, raw[at:])).decode()
                texts.append(text)
            yield batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))

    return docs.mapInArrow(masked, docs.schema)


def _joined(spans) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])))


def result(docs: DataFrame) -> DataFrame:
    """``doc_id``, a count per rule, the SHA-256 of the rules' spans, and all spans as text."""
    found = scan(docs, fit(docs))
    base = F.filter("spans", lambda x: x["kind"] != KINDS[3])
    kinds = F.transform("spans", lambda x: x["kind"])
    counts = [(F.size("spans") - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in KINDS[:3]]
    return found.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
