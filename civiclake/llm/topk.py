"""Exact top-k inner products: vectors by descending length, SVD-rotated partial sums, Cauchy-Schwarz bounds.

Vectors become integers, are sorted by length and packed into blocks. The block of the longest gives every query a first
threshold. A block whose longest vector times the query's length is under the threshold can't change the query's result, and as
blocks get shorter, neither can any after it. Within a block, inner products are summed over the leading rotated dimensions;
what the rest can add is at most the product of the residual lengths. Pairs that may still reach the threshold are worked out
exactly, in integers. Queries are packed too, so blocks meet blocks, and no task holds more than one of each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civiclake.llm.common import stored
from civiclake.operators.numbering import surrogate_key

SCALE = 256
#: Vectors in a block, queries in a chunk, queries bounded at once.
BLOCK = 4096
CHUNK = 2048
ROWS = 64
#: Rotated dimensions summed before each pruning, as shares of all.
STAGES = (0.25, 0.5)
#: Steps of block lengths that every task knows; a query's blocks are rounded up to a step.
LADDER = 4096
#: Room for rounding in the bounds, as a share of both lengths' product.
ROUNDING = 1e-9


def whole_vectors(of: str) -> Column:
    """Whether a vector column and all its components are finite and not null."""
    return F.coalesce(
        F.forall(of, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)
    )


def _integers(scale: int) -> Callable:
    def integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [np.floor(scale * np.array(v, dtype=np.float64)) for v in batch.column("v").to_pylist()]
            lengths = [float(np.sqrt(v @ v)) for v in vectors]
            if lengths and max(lengths) >= 2.0**31:
                raise ValueError("scores would not fit 64 bits")
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id"), pa.array(lengths, pa.float64()), pa.array([len(v) for v in vectors], pa.int32()),
                pa.array([v.astype("<i8").tobytes() for v in vectors], pa.binary()),
            ], ["vec_id", "length", "size", "v"])

    return integers


def _matrix(vectors, size: int) -> np.ndarray:
    """Rows of 64-bit integers; shorter vectors are filled up with zeros."""
    found = np.zeros((len(vectors), size), dtype=np.int64)
    for k, v in enumerate(vectors):
        row = np.frombuffer(v, "<i8")
        found[k, :len(row)] = row
    return found


def _second_moments(size: int) -> Callable:
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            x = _matrix(batch.column("v").to_pylist(), size).astype(np.float64)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size * size)), pa.array(total.ravel())], ["place", "value"])

    return summed


def rotation(vectors: DataFrame, size: int) -> np.ndarray:
    """The right singular vectors of all rows, largest first. The driver gets size * size sums, whatever the number of rows."""
    sums = vectors.mapInArrow(_second_moments(size), "place long, value double").groupBy("place").agg(F.sum("value").alias("value"))
    moments = np.zeros(size * size)
    for place, value in sums.collect():
        moments[place] = value
    _, axes = np.linalg.eigh(moments.reshape(size, size))
    return np.ascontiguousarray(axes[:, ::-1])


def _packed(most: int, size: int) -> Callable:
    """Rows of one partition, in order, as blocks: ids, lengths and vectors of up to ``most`` rows."""
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows, keys = [], [], []

        def block() -> pa.RecordBatch:
            x = _matrix(rows, size)
            lengths = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
            return pa.RecordBatch.from_arrays([
                pa.array([float(lengths.max())], pa.float64()), pa.array([np.array(ids, "<i8").tobytes()], pa.binary()),
                pa.array([np.array(keys, "<i8").tobytes()], pa.binary()), pa.array([x.tobytes()], pa.binary()),
            ], ["longest", "ids", "keys", "vectors"])

        for batch in batches:
            for vec_id, key, v in zip(*(batch.column(name).to_pylist() for name in ("vec_id", "key", "v"))):
                ids.append(vec_id)
                keys.append(key)
                rows.append(v)
                if len(rows) == most:
                    yield block()
                    ids, rows, keys = [], [], []
        if rows:
            yield block()

    return packed


PACKED = "longest double, ids binary, keys binary, vectors binary"


def _exact(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Integer inner products: by floating point where every sum is exact, else in 64-bit integers."""
    if not queries.size or not vectors.size:
        return np.zeros((len(queries), len(vectors)), np.int64)
    bound = np.abs(queries).max() * float(np.abs(vectors).max()) * queries.shape[1]
    if bound < 2.0**53:
        return (queries.astype(np.float64) @ vectors.T.astype(np.float64)).astype(np.int64)
    return queries @ vectors.T


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to the smaller id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= least)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))][:k]


def search_block(queries, query_ids, thresholds, vectors, ids, axes, k: int) -> list[tuple[int, int, int]]:
    """(query row, id, score) of the up to ``k`` best of a block per query, leaving out scores under its threshold."""
    size = queries.shape[1]
    cuts = [0, *sorted({min(size, max(1, round(size * share))) for share in STAGES})] if size else [0]
    turned = vectors.astype(np.float64) @ axes
    squares, lengths = (turned**2).cumsum(axis=1), np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
    found = []
    for start in range(0, len(queries), ROWS):
        own = queries[start:start + ROWS]
        own_turned = own.astype(np.float64) @ axes
        own_squares, own_lengths = (own_turned**2).cumsum(axis=1), np.sqrt((own.astype(np.float64) ** 2).sum(axis=1))
        needed = thresholds[start:start + ROWS]
        at_query, at_vector = np.nonzero(own_lengths[:, None] * lengths * (1 + ROUNDING) >= needed[:, None])
        sums = np.zeros(len(at_query))
        for low, high in zip(cuts, cuts[1:]):
            part = own_turned[:, low:high] @ turned[:, low:high].T
            sums = sums + part[at_query, at_vector]
            rest_query = np.sqrt(np.maximum(own_lengths**2 - own_squares[:, high - 1], 0))
            rest_vector = np.sqrt(np.maximum(lengths**2 - squares[:, high - 1], 0))
            room = rest_query[at_query] * rest_vector[at_vector] + ROUNDING * own_lengths[at_query] * lengths[at_vector] + 1e-6
            open_pairs = sums + room >= needed[at_query]
            at_query, at_vector, sums = at_query[open_pairs], at_vector[open_pairs], sums[open_pairs]
        bounds = np.searchsorted(at_query, np.arange(len(own) + 1))
        for row in range(len(own)):
            near = at_vector[bounds[row]:bounds[row + 1]]
            near = near[ids[near] != query_ids[start + row]]
            scores = _exact(own[row:row + 1], vectors[near])[0]
            best = _best(scores, ids[near], k)
            found += [(start + row, int(ids[near[b]]), int(scores[b])) for b in best if scores[b] >= needed[row]]
    return found


def _unpacked(row, size: int):
    ids = np.frombuffer(row["ids"], "<i8")
    return ids, np.frombuffer(row["keys"], "<i8"), np.frombuffer(row["vectors"], "<i8").reshape(len(ids), size)


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding",
    scale: int = SCALE,
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id``, ``score``: the ``k`` highest integer inner products of each query row.

    Queries are the rows that ``is_query`` holds for; candidates are all rows, but for those with the query's own id. A vector
    that is null or has a null or non-finite component takes no part, nor does a row with a null id. Components become
    floor(scale * x). Vectors of different lengths compare as if filled up with zeros. Ties go to the smaller id. Each of
    repeated rows is a query and a candidate of its own. Fewer candidates than ``k``: all. An empty table gives an empty one.
    Vectors so long that scores might not fit 64 bits are an error. Other columns are ignored.
    """
    spark = vectors.sparkSession
    chosen = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("v"), is_query.alias("is_query")
    ).where(F.col("vec_id").isNotNull() & whole_vectors("v"))
    integers = chosen.select("vec_id", "v").mapInArrow(_integers(scale), "vec_id long, length double, size int, v binary")
    rows = stored(integers, "vectors")
    count, size = rows.agg(F.count("*"), F.coalesce(F.max("size"), F.lit(0))).first()
    axes = spark.sparkContext.broadcast(rotation(rows, size) if size else np.zeros((0, 0)))

    # blocks by descending length, the longest first; ids part rows of one length
    parts = max(1, -(-count // (4 * BLOCK)))
    sorted_rows = (
        rows.withColumn("key", F.lit(0).cast("long")).withColumn("back", -F.col("length"))
        .repartitionByRange(parts, "back", F.xxhash64("vec_id")).sortWithinPartitions("back")
    )
    packed = sorted_rows.select("vec_id", "key", "v").mapInArrow(_packed(BLOCK, size), PACKED)
    packed = stored(packed.withColumn("back", -F.col("longest")), "blocks")
    numbers = surrogate_key(
        packed.select("back", F.xxhash64("ids", "vectors").alias("content")), "number", ["back", "content"]
    ).groupBy("back", "content").agg(F.min("number").alias("number"))
    blocks = packed.withColumn("content", F.xxhash64("ids", "vectors")).join(numbers, ["back", "content"]).select(
        (F.col("number") - 1).alias("block"), "longest", "ids", "keys", "vectors"
    )
    blocks = stored(blocks, "numbered-blocks")
    many = blocks.agg(F.coalesce(F.max("block") + 1, F.lit(0))).first()[0]
    seed = blocks.where("block = 0").limit(1).collect()
    step = max(1, -(-many // LADDER))
    ladder = blocks.where(F.col("block") % step == 0).groupBy("block").agg(F.max("longest")).orderBy("block").collect()
    if not seed:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    known = spark.sparkContext.broadcast((seed[0].asDict(), np.array([x[0] for x in ladder]), np.array([x[1] for x in ladder])))

    def thresholds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, ladder_blocks, ladder_lengths = known.value
        ids, _, x = _unpacked(first, size)
        for batch in batches:
            for row in batch.to_pylist():
                query_ids, keys, queries = _unpacked(row, size)
                least = np.full(len(query_ids), -np.inf)
                for start in range(0, len(queries), ROWS):
                    scores = _exact(queries[start:start + ROWS], x)
                    for at, own in enumerate(scores, start):
                        own = own[ids != query_ids[at]]
                        if len(own) >= k:
                            least[at] = np.partition(own, len(own) - k)[len(own) - k]
                lengths = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))
                # the blocks that any query here may need: those before the first step that is too short for all
                reaches = (lengths[:, None] * ladder_lengths * (1 + ROUNDING) + 1e-6 >= least[:, None]).any(axis=0)
                steps = int(np.flatnonzero(reaches).max()) + 1 if reaches.any() else 0
                upto = int(ladder_blocks[steps]) if steps < len(ladder_blocks) else many
                yield pa.RecordBatch.from_arrays([
                    pa.array([int(keys[0])], pa.int64()), pa.array([upto], pa.int64()), pa.array([row["ids"]], pa.binary()),
                    pa.array([row["keys"]], pa.binary()), pa.array([row["vectors"]], pa.binary()),
                    pa.array([least.tobytes()], pa.binary()),
                ], ["chunk", "upto", "ids", "keys", "vectors", "least"])

    query_rows = stored(
        rows.join(chosen.where("is_query").select("vec_id").distinct(), "vec_id", "left_semi")
        .select("vec_id", F.monotonically_increasing_id().alias("key"), "v"), "queries"
    )
    chunks = query_rows.mapInArrow(_packed(CHUNK, size), PACKED).mapInArrow(
        thresholds, "chunk long, upto long, ids binary, keys binary, vectors binary, least binary"
    )
    chunks = stored(chunks, "chunks")

    def searched(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        for _, block in left.iterrows():
            ids, _, x = _unpacked(block, size)
            for _, chunk in right.iterrows():
                query_ids, keys, queries = _unpacked(chunk, size)
                least = np.frombuffer(chunk["least"], np.float64)
                found += [
                    (int(keys[row]), int(query_ids[row]), vec_id, score)
                    for row, vec_id, score in search_block(queries, query_ids, least, x, ids, axes.value, k)
                ]
        return pd.DataFrame(found, columns=["key", "query_id", "vec_id", "score"])

    upto = F.explode(F.sequence(F.lit(0).cast("long"), F.col("upto") - 1))
    asked = chunks.where("upto > 0").withColumn("block", upto)
    met = blocks.join(asked.select("block", F.col("chunk").alias("of")), "block").withColumnRenamed("of", "chunk")
    hits = met.groupBy("block", "chunk").cogroup(asked.groupBy("block", "chunk")).applyInPandas(
        searched, "key long, query_id long, vec_id long, score long"
    )
    place = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def result(embeddings: DataFrame) -> DataFrame:
    return top_k(embeddings, F.col("vec_id") % 50 == 0)


def oracle() -> str:
    return """
    with whole as (
        select vec_id, list_transform(embedding, lambda x: cast(floor(256 * x::double) as bigint)) as v from embeddings
        where embedding is not null and vec_id is not null
            and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    scored as (
        select q.vec_id as query_id, c.vec_id as vec_id,
            cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
        from whole q join whole c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id)
    select query_id, cast(rank as integer) as rank, vec_id, score from (
        select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored) where rank <= 5"""
