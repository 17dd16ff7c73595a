"""Document fingerprints: bottom-k sketches of word shingle hashes, in built-in expressions.

A sketch is the sorted array of a text's K smallest distinct shingle hashes. Sketches of parts merge into the whole's, and two of
them estimate resemblance, containment and the number of distinct shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civiclake.llm.common import stored
from civiclake.operators.numbering import surrogate_key

SHINGLE = 5
K = 128
#: Hashes have so many bits, so they are positive and sort as they are.
BITS = 48
GAP = r"[\x20\x09-\x0D]+"


def with_sketch(df: DataFrame, text: str, name: str, k: int = K) -> DataFrame:
    """Adds ``name``, the sketch of the text column ``text``.

    Texts of fewer than five words are one shingle; null texts and those without words have an empty sketch.
    """
    words, hashes = f"{name}_words", f"{name}_hashes"
    kept = df.columns
    split = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), GAP), lambda word: word != "")
    hashed = df.withColumn(words, F.transform(split, lambda word: F.xxhash64(word)))
    last = F.greatest(F.size(words) - SHINGLE, F.lit(0))
    starts = F.when(F.size(words) > 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    shingles = F.transform(starts, lambda at: F.shiftrightunsigned(
        F.xxhash64(*(F.get(words, at + k) for k in range(SHINGLE))), 64 - BITS
    ))
    least = F.slice(F.sort_array(F.array_distinct(F.col(hashes))), 1, k)
    return hashed.withColumn(hashes, shingles).select(*kept, least.alias(name))


def merge(a: str, b: str, k: int = K) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merged(sketches: DataFrame, key: str, sketch: str, k: int = K) -> DataFrame:
    """One sketch per key out of any number of parts' sketches; each map task sends at most ``k`` values per key."""
    values = sketches.select(F.col(key), F.explode(sketch).alias("value")).distinct()
    place = F.row_number().over(Window.partitionBy(key).orderBy("value"))
    least = values.withColumn("place", place).where(F.col("place") <= k)
    found = least.groupBy(key).agg(F.sort_array(F.collect_list("value")).alias(sketch))
    keys = sketches.select(key).distinct()
    empty = F.array().cast("array<bigint>")
    joined = keys.alias("keys").join(found.alias("found"), F.col(f"keys.{key}").eqNullSafe(F.col(f"found.{key}")), "left")
    return joined.select(F.col(f"keys.{key}").alias(key), F.coalesce(F.col(sketch), empty).alias(sketch))


def distinct_shingles(a: str, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) * 2.0**BITS / F.element_at(a, k))


def resemblance(a: str, b: str, k: int = K) -> Column:
    """Estimated share of shared among all distinct shingles. Two empty sketches: 1; one: 0."""
    both = merge(a, b, k)
    shared = F.size(F.array_intersect(F.array_intersect(both, F.col(a)), F.col(b)))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(shared / F.size(both))


def containment(a: str, b: str, k: int = K) -> Column:
    """Estimated share of ``a``'s distinct shingles that ``b`` has. An empty ``a``: 1."""
    alike = resemblance(a, b, k)
    shared = alike / (1 + alike) * (distinct_shingles(a, k) + distinct_shingles(b, k))
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), shared / distinct_shingles(a, k)))


def digits(sketch: str) -> Column:
    """A sketch as text, twelve hex digits per hash."""
    return F.array_join(F.transform(sketch, lambda x: F.lower(F.lpad(F.hex(x), BITS // 4, "0"))), "")


def with_next_lead(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Each row's ``doc_id``, ``text``, and of the next document ``lead``, its first floor(n_chars / 2) characters (n_chars of
    the row), and ``next_sketch``.

    Documents are in descending order of ids; after the last comes the first. Null ids come first; rows with one id go by a
    hash of their texts; rows equal in both are one document and get the same answer. Whole texts are shuffled once, and leads
    once; the order is found from ids and lengths alone.
    """
    keyed = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    ).withColumns({"key": F.xxhash64("doc_id", "text"), "more": F.hash("text")})
    places = keyed.groupBy("key", "more").agg(
        F.first("doc_id").alias("doc_id"), F.first(F.char_length("text")).alias("n"), F.count("*").alias("copies")
    ).withColumn("back", F.bitwise_not("doc_id"))
    numbered = stored(surrogate_key(places, "number", ["back", "key", "more"]), "order")
    count, copies = numbered.agg(F.count("*"), F.max("copies")).first()
    # a document sends its lead to the one before it
    receivers = numbered.select(
        F.when(F.col("number") == count, 1).otherwise(F.col("number") + 1).alias("number"), F.col("key").alias("to_key"),
        F.col("more").alias("to_more"), F.col("doc_id").alias("to_doc"), F.expr("n div 2").cast("int").alias("need"),
    )
    senders = numbered.select("number", F.col("key").alias("from_key"), F.col("more").alias("from_more"))
    sends = stored(senders.join(receivers, "number").drop("number"), "sends")
    # both sides of the second join have the same three columns of the texts, so that one shuffle of them serves both
    texts = keyed.drop("doc_id")
    sent = texts.join(
        sends.hint("merge"), (texts["key"] == sends["from_key"]) & (texts["more"] == sends["from_more"])
    ).select("to_key", "to_more", "to_doc", F.substring("text", F.lit(1), F.col("need")).alias("lead"), "text")
    sent = with_sketch(sent, "text", "next_sketch").drop("text")
    if copies and copies > 1:
        sent = sent.dropDuplicates(["to_key", "to_more"])
    sent = sent.hint("merge")
    return texts.join(sent, (texts["key"] == sent["to_key"]) & (texts["more"] == sent["to_more"])).select(
        F.col("to_doc").alias("doc_id"), "text", "lead", "next_sketch"
    )


def result(docs: DataFrame) -> DataFrame:
    """Fingerprints of each document and of its edited text, whose last half is replaced by the next document's start."""
    n = F.char_length("text")
    edited = F.concat(F.substring("text", F.lit(1), n - F.expr("char_length(text) div 2").cast("int")), F.col("lead"))
    rows = with_next_lead(docs, "doc_id", "text").select(
        "doc_id", "text", n.cast("long").alias("n_chars"), edited.alias("edited"), "next_sketch"
    )
    rows = with_sketch(rows, "text", "sketch").select(
        "doc_id", "n_chars", "edited", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "sketch", "next_sketch"
    )
    rows = with_sketch(rows, "edited", "edited_sketch")
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", digits("sketch").alias("fingerprint"),
        digits("edited_sketch").alias("edited_fingerprint"), resemblance("sketch", "edited_sketch").alias("near_edited"),
        resemblance("sketch", "next_sketch").alias("near_next"),
        F.round(distinct_shingles("sketch")).cast("long").alias("distinct_shingles"),
        containment("edited_sketch", "sketch").alias("edited_contained"),
    )
