"""Near-duplicates by SimHash fingerprints, found by multi-index hashing.

Fingerprints of 64 bits link at up to three differing bits. A fingerprint is cut into two segments of 32 bits. If two
fingerprints differ in at most three bits, one segment differs in at most one, so looking up the 33 values of the ball of
radius one around each segment in a table of all segments finds every link. The work is linear in the number of distinct
fingerprints, whatever the group sizes: exact copies are one fingerprint, and a join row is a verified link.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclake.llm.common import digits, id_and_bytes, stored
from civiclake.llm.components import components

SHINGLE = 3
SEED = 42
DISTANCE = 3
#: Shingles whose bits are counted at once; bounds memory on very long texts.
BLOCK = 1 << 16
#: A fingerprint's segments, and the ball of radius DISTANCE // 2 around one.
SEGMENT_BITS = 32
BALL = [0, *(1 << bit for bit in range(SEGMENT_BITS))]

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: bytes) -> int:
    """The SimHash of a whole text: XXH64 of word shingles, one vote per shingle and bit. No words: 0."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles, count = iter([b" ".join(words)]), 1
    else:
        shingles, count = map(b" ".join, zip(*(words[k:] for k in range(SHINGLE)))), len(words) - SHINGLE + 1
    hashes, votes, left = map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.zeros(64, dtype=np.int64), count
    while left:
        block = min(left, BLOCK)
        octets = np.fromiter(hashes, dtype=">u8", count=block).view(np.uint8).reshape(-1, 8)
        for k in range(8):
            votes[8 * k:8 * k + 8] += np.bincount(octets[:, k], minlength=256) @ _BITS
        left -= block
    return int.from_bytes(np.packbits(2 * votes > count).tobytes(), "big")


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.fromiter(
            (fingerprint(text.as_py()) for text in batch.column("text")), dtype=np.uint64, count=batch.num_rows
        )
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id`` and ``fp``, the fingerprint's bits as a long."""
    return id_and_bytes(docs, id_column, text_column).mapInArrow(_fingerprint_batches, "doc_id long, fp long")


def links(distinct: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Each linked pair ``a < b`` of the distinct longs in ``fp``, at least once. ``distance`` is at most 3."""
    if not 0 <= distance <= DISTANCE:
        raise ValueError("the ball of radius one finds distances of up to 3")
    low = F.col("fp").bitwiseAND((1 << SEGMENT_BITS) - 1)
    high = F.shiftrightunsigned("fp", SEGMENT_BITS)
    segments = distinct.select(
        "fp", F.posexplode(F.array(low, high)).alias("segment", "value")
    ).select("fp", (F.shiftleft(F.col("segment").cast("long"), SEGMENT_BITS) + F.col("value")).alias("key"))
    # only a probe's own segment changes, never the segment number above it
    masks = F.array(*(F.lit(mask).cast("long") for mask in BALL))
    probes = segments.select(F.col("fp").alias("a"), F.explode(masks).alias("mask"), "key").select(
        "a", F.col("key").bitwiseXOR(F.col("mask")).alias("key")
    )
    entries = segments.select(F.col("fp").alias("b"), "key")
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    return probes.join(entries.hint("merge"), (probes["key"] == entries["key"]) & near).select("a", "b")


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", distance: int = DISTANCE
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fp`` and ``component_id``, the smallest ``doc_id`` reachable over links.

    Null texts count as empty; texts without words have fingerprint 0 and are linked like any other. Texts of fewer than
    three words are one shingle. Repeated rows stay, in one component. A null ``doc_id`` is never a component's id, unless
    all its ids are null. An empty table gives an empty one. Other columns are ignored.
    """
    rows = stored(fingerprints(docs, id_column, text_column), "fingerprints")
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    roots = components(links(distinct.select("fp"), distance)).withColumnRenamed("node", "fp")
    grouped = distinct.join(roots.hint("merge"), "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = grouped.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = stored(grouped.join(least.hint("merge"), "root").select("fp", "component_id"), "classes")
    return rows.join(classes.hint("merge"), "fp").select("doc_id", "fp", "component_id")


def result(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fingerprint`` as 16 hex digits, ``component_id``."""
    return near_duplicates(docs).select("doc_id", digits(F.col("fp")).alias("fingerprint"), "component_id")
