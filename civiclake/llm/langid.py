"""Language identification by interpolated Kneser-Ney character models.

One model per language. All models are looked up at once: for each order, a sorted array of n-gram hashes with a row of log
probabilities, one per language, and a sorted array of context hashes with a row of back-off weights. A text gets the
language of the lowest cross-entropy per symbol, and is rejected where that is far above what the language's own texts have.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from civiclake.llm.common import stored

ORDER = 4
DISCOUNT = 0.75
UNDETERMINED = "und"
#: Labelled documents of distinct texts per language that the models are fitted on. Which ones a hash says. All others calibrate.
FIT_DOCUMENTS = 400
#: Shares of a language that are cut to their first texts on their own.
SHARES = 16
#: Share of a language's calibration documents whose excess is within the one that the limit is made of.
RECALL = 0.999
#: Symbols of a text that are looked up at once; bounds memory on very long texts.
BLOCK = 1 << 17
#: A text is rejected where its cross-entropy exceeds its language's mean by more than MARGIN nats plus SLACK times the
#: RECALL quantile of the excess seen in calibration, which is measured times the root of the number of symbols and shrinks by it.
SLACK = 2.0
MARGIN = 0.5

SPACE = 32
#: Odd multipliers of the n-gram hash, one per place counted from the last symbol.
_MULTIPLIERS = np.random.default_rng(7).integers(1 << 62, 1 << 63, size=ORDER, dtype=np.uint64) | np.uint64(1)
_fold: list[np.ndarray] = []


def fold_table() -> np.ndarray:
    """Code point to lower-case letter, or to a blank if it is no letter."""
    if not _fold:
        table = np.full(0x110000, SPACE, dtype=np.uint32)
        for point in range(0x110000):
            letter = chr(point)
            if letter.isalpha():
                table[point] = ord(letter.lower()[0])
        _fold.append(table)
    return _fold[0]


def symbols(text: str) -> Iterator[np.ndarray]:
    """The text's letters in lower case, each run of other characters one blank, in blocks; before and after, a blank."""
    table, blank = fold_table(), True
    yield np.array([SPACE], dtype=np.uint32)
    for start in range(0, len(text), BLOCK):
        points = np.frombuffer(text[start:start + BLOCK].encode("utf-32-le", "replace"), dtype=np.uint32)
        block = table[points]
        is_blank = block == SPACE
        before = np.concatenate(([blank], is_blank[:-1]))
        blank = bool(is_blank[-1])
        yield block[~(is_blank & before)]
    if not blank:
        yield np.array([SPACE], dtype=np.uint32)


def windows(text: str) -> Iterator[np.ndarray]:
    """Blocks of symbols with the ORDER - 1 symbols before them in front; each symbol is the last of one n-gram."""
    carried = np.full(ORDER - 1, SPACE, dtype=np.uint32)
    first = True
    for block in symbols(text):
        if first:
            first = False
            continue
        if len(block):
            joined = np.concatenate((carried, block))
            yield joined
            carried = joined[-(ORDER - 1):]


def hashes(joined: np.ndarray, order: int) -> np.ndarray:
    """Hash of the n-gram of ``order`` symbols ending at each symbol from the ORDER-th on."""
    count, wide = len(joined) - ORDER + 1, joined.astype(np.uint64)
    found = np.full(count, np.uint64(order), dtype=np.uint64)
    for back in range(order):
        start = ORDER - 1 - back
        found += wide[start:start + count] * _MULTIPLIERS[back]
    return found


def _gram_hash(gram: str) -> int:
    found = len(gram)
    for back, letter in enumerate(reversed(gram)):
        found += ord(letter) * int(_MULTIPLIERS[back])
    return found & (2**64 - 1)


@dataclass
class Models:
    """Sorted hash arrays of all languages. ``grams[n]``: hashes and log probabilities; ``contexts[n]``: hashes of the
    n-1 symbols before and log back-off weights of order n. ``floor``: log probability of a symbol never seen."""

    languages: list[str]
    grams: dict[int, tuple[np.ndarray, np.ndarray]]
    contexts: dict[int, tuple[np.ndarray, np.ndarray]]
    floor: np.ndarray
    mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    limit: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def log_probabilities(self, joined: np.ndarray) -> np.ndarray:
        """Summed log probability of a block of symbols, per language."""
        total = np.zeros(len(self.languages))
        left = np.arange(len(joined) - ORDER + 1)
        for order in range(ORDER, 0, -1):
            keys, values = self.grams[order]
            wanted = hashes(joined, order)[left]
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            hit = keys[at] == wanted
            total += np.bincount(at[hit], minlength=len(keys)) @ values
            left = left[~hit]
            if not len(left):
                break
            if order > 1:
                keys, values = self.contexts[order]
                wanted = hashes(np.concatenate(([SPACE], joined[:-1])), order - 1)[left]
                at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                total += np.bincount(at[keys[at] == wanted], minlength=len(keys)) @ values
        else:
            total += len(left) * self.floor
        return total

    def cross_entropy(self, text: str | None) -> tuple[np.ndarray, int]:
        """Nats per symbol under each language's model, and the number of symbols; 0 symbols if there is no letter."""
        total, count = np.zeros(len(self.languages)), 0
        for joined in windows(text or ""):
            total += self.log_probabilities(joined)
            count += len(joined) - ORDER + 1
        return -total / max(count, 1), count

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, confidence, and whether the text is like that language's texts."""
        if not self.languages:
            return UNDETERMINED, 0.0, False
        entropy, count = self.cross_entropy(text)
        if not count:
            return UNDETERMINED, 0.0, False
        best = int(np.argmin(entropy))
        weights = np.exp(-(entropy - entropy[best]) * np.sqrt(count))
        excess = (entropy[best] - self.mean[best] - MARGIN) * np.sqrt(count)
        return self.languages[best], float(1 / weights.sum()), bool(excess <= self.limit[best])


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the whole n-grams in a batch, by language."""
    for batch in batches:
        counts: dict[tuple[str, str], int] = {}
        for text, language in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            for joined in windows(text):
                letters = joined.tobytes().decode("utf-32-le", "replace")
                for start in range(len(joined) - ORDER + 1):
                    key = language, letters[start:start + ORDER]
                    counts[key] = counts.get(key, 0) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.string()),
             pa.array(counts.values(), pa.int64())], ["lang", "gram", "n"]
        )


def kneser_ney(counts: dict[str, int]) -> tuple[dict[int, dict[str, float]], dict[int, dict[str, float]], float]:
    """Interpolated probabilities by order and n-gram, back-off weights by order and context, and the floor."""
    by_order = {ORDER: counts}
    for order in range(ORDER - 1, 0, -1):  # lower orders count in how many different places an n-gram goes on
        lower: dict[str, int] = {}
        for gram in by_order[order + 1]:
            lower[gram[1:]] = lower.get(gram[1:], 0) + 1
        by_order[order] = lower
    floor = 1 / (len(by_order[1]) + 1)
    below: dict[str, float] = {}
    probabilities, weights = {}, {}
    for order in range(1, ORDER + 1):
        totals: dict[str, int] = {}
        kinds: dict[str, int] = {}
        for gram, n in by_order[order].items():
            totals[gram[:-1]] = totals.get(gram[:-1], 0) + n
            kinds[gram[:-1]] = kinds.get(gram[:-1], 0) + 1
        weights[order] = {context: DISCOUNT * kinds[context] / totals[context] for context in totals}
        below = {
            gram: (n - DISCOUNT) / totals[gram[:-1]] + weights[order][gram[:-1]] * (below[gram[1:]] if order > 1 else floor)
            for gram, n in by_order[order].items()
        }
        probabilities[order] = below
    return probabilities, weights, weights[1].get("", 1.0) * floor


MODEL_ROWS = "lang string, kind string, n int, gram string, value double"


def _fit_language(rows: pd.DataFrame) -> pd.DataFrame:
    language = rows["lang"].iloc[0]
    probabilities, weights, floor = kneser_ney(dict(zip(rows["gram"], rows["n"])))
    found = [("gram", n, gram, p) for n, of in probabilities.items() for gram, p in of.items()]
    found += [("context", n, gram, w) for n, of in weights.items() if n > 1 for gram, w in of.items()]
    found.append(("floor", 0, "", floor))
    out = pd.DataFrame(found, columns=["kind", "n", "gram", "value"])
    out.insert(0, "lang", language)
    return out


def _arrays(rows: pd.DataFrame) -> Models:
    """The sorted hash arrays out of the models' rows. Where a language lacks an n-gram, its back-off is worked out here."""
    languages = sorted(rows["lang"].unique())
    place = {name: k for k, name in enumerate(languages)}
    floor = np.zeros(len(languages))
    tables: dict[tuple[str, int], dict[str, np.ndarray]] = {}
    for language, kind, n, gram, value in rows.itertuples(index=False):
        if kind == "floor":
            floor[place[language]] = value
        else:
            tables.setdefault((kind, n), {}).setdefault(gram, np.full(len(languages), np.nan))[place[language]] = value
    grams, contexts, below = {}, {}, {}
    for order in range(1, ORDER + 1):
        weight = tables.get(("context", order), {})
        one = np.ones(len(languages))
        weight = {context: np.where(np.isnan(of), 1.0, of) for context, of in weight.items()}
        full = {}
        for gram, own in tables.get(("gram", order), {}).items():
            lower = below.get(gram[1:], floor) if order > 1 else floor
            full[gram] = np.where(np.isnan(own), weight.get(gram[:-1], one) * lower, own)
        grams[order], contexts[order] = _sorted(full, len(languages)), _sorted(weight, len(languages))
        below = full
    return Models(languages, grams, contexts, np.log(floor))


def _sorted(values: dict[str, np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    if not values:
        return np.zeros(1, dtype=np.uint64), np.zeros((1, width))
    keys = np.fromiter((_gram_hash(gram) for gram in values), dtype=np.uint64, count=len(values))
    order = np.argsort(keys)
    return keys[order], np.log(np.array(list(values.values())))[order]


def held_out(id_column: str = "doc_id"):
    """Whether a document is never learned from; false for a null id, which isn't learned from either."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
    documents: int = FIT_DOCUMENTS,
) -> Models:
    """Models of all languages among the labelled documents that aren't held out.

    Each language is fitted on up to ``documents`` distinct whole texts, every other one by a hash of their ids, and its
    rejection limit is set on all rows of other texts. So the models' size has a bound per language, whatever the size of
    ``docs``, and the limit none. Rows whose text,
    label or id is null teach nothing. Without any label, there are no languages and every text is undetermined.
    """
    spark = docs.sparkSession
    eligible = docs.select(
        F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"), F.col(lang_column).alias("lang")
    ).where(F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out("doc_id"))
    eligible = eligible.withColumn("key", F.xxhash64("text"))
    order = F.xxhash64("doc_id"), "doc_id", "key"
    texts = eligible.groupBy("lang", "key").agg(F.min("doc_id").alias("doc_id"))
    # the first of every share of a language, then the first of those: no task reads a whole language's candidates
    shares = Window.partitionBy("lang", F.pmod("key", F.lit(SHARES))).orderBy(*order)
    texts = texts.withColumn("place", F.row_number().over(shares)).where(F.col("place") <= 2 * documents).drop("place")
    first = Window.partitionBy("lang").orderBy(*order)
    chosen = (
        texts.withColumn("place", F.row_number().over(first))
        .where((F.col("place") <= 2 * documents) & (F.col("place") % 2 == 1)).drop("place")
    )
    chosen = stored(chosen, "lid")  # bounded: documents rows per language
    fitted = eligible.join(F.broadcast(chosen), ["lang", "key", "doc_id"]).select("lang", "key", "text").distinct()
    fitted = fitted.repartition(spark.sparkContext.defaultParallelism).select("lang", "text")
    counts = fitted.mapInArrow(_gram_counts, "lang string, gram string, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n")
    )
    rows = counts.groupBy("lang").applyInPandas(_fit_language, MODEL_ROWS).toPandas()
    models = _arrays(rows)
    sent = spark.sparkContext.broadcast(models)

    def entropies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = sent.value
        for batch in batches:
            found = []
            for text, language in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                if language in models.languages:
                    entropy, count = models.cross_entropy(text)
                    if count:
                        found.append((language, float(entropy[models.languages.index(language)]), count))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("lang", "entropy", "n"), x)) for x in found],
                pa.schema([("lang", pa.string()), ("entropy", pa.float64()), ("n", pa.int64())]),
            )

    others = eligible.join(F.broadcast(chosen.select("lang", "key")), ["lang", "key"], "left_anti").select("text", "lang")
    seen = stored(others.mapInArrow(entropies, "lang string, entropy double, n long"), "lid_seen")
    means = seen.groupBy("lang").agg((F.sum(F.col("entropy") * F.col("n")) / F.sum("n")).alias("mean"))
    excess = ((F.col("entropy") - F.col("mean")) * F.sqrt("n"))
    limits = seen.join(F.broadcast(means), "lang").groupBy("lang").agg(
        F.first("mean").alias("mean"), F.percentile_approx(excess, RECALL, 10_000).alias("excess")
    ).collect()
    models.mean, models.limit = np.zeros(len(models.languages)), np.full(len(models.languages), np.inf)
    for row in limits:
        k = models.languages.index(row["lang"])
        models.mean[k], models.limit[k] = row["mean"], max(SLACK * row["excess"], 0.0)
    return models


def identify(
    docs: DataFrame, models: Models, text_column: str = "text",
    columns: tuple[str, str, str] = ("lang_pred", "score", "accepted"),
) -> DataFrame:
    """``docs`` with three columns added: the language, a confidence from 0 to 1, and whether the text is accepted.

    The prediction reads nothing but the whole text. A text that is null or has no letter is ``und`` with score 0 and isn't
    accepted. Equal cross-entropies go to the first language by name. Repeated rows get the same answer. A column of ``docs``
    with one of the added names is an error; name others then.
    """
    clash = set(columns) & set(docs.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist")
    sent = docs.sparkSession.sparkContext.broadcast(models)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = sent.value
        for batch in batches:
            found = [models.predict(text.as_py()) for text in batch.column(batch.schema.get_field_index(text_column))]
            added = [pa.array([x[k] for x in found], kind) for k, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, *columns])

    schema = T.StructType([
        *docs.schema.fields, T.StructField(columns[0], T.StringType()), T.StructField(columns[1], T.DoubleType()),
        T.StructField(columns[2], T.BooleanType()),
    ])
    return docs.mapInArrow(predict, schema)


def result(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score``, ``accepted`` of every document."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return identify(texts, fit(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "accepted")
