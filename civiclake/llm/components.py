"""Connected components of a table of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclake.llm.common import stored


def _least(edges: DataFrame) -> DataFrame:
    """Each node ``u`` with its smallest neighbour ``m``; summed in the map tasks, so a hub moves one row per task."""
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one batch at a time as stars around their smallest nodes, which connect the same nodes by fewer links."""
    for batch in batches:
        parent: dict[int, int] = {}

        def root(node: int) -> int:
            while (above := parent.setdefault(node, node)) != node:
                parent[node] = parent[above]
                node = above
            return node

        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            low, high = sorted((root(u), root(v)))
            parent[high] = low
        stars = [(node, at) for node in parent if (at := root(node)) != node]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[k] for x in stars], pa.int64()) for k in (0, 1)], ["u", "v"]
        )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both).withColumn("m", F.least("u", "m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    joined = edges.join(_least(edges), "u")
    return (
        joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        .union(joined.select("u", F.col("m").alias("v"))).distinct()
    )


def _unfinished(edges: DataFrame) -> bool:
    """Whether a node has two roots, or is a root and has one."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("child"), F.lit(0).alias("root")).union(
        edges.select(F.col("v").alias("node"), F.lit(0), F.lit(1))
    )
    seen = ends.groupBy("node").agg(F.sum("child").alias("child"), F.max("root").alias("root"))
    return not seen.where("child + root > 1").isEmpty()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Each node of ``links`` (two long columns) as ``node`` with ``root``, the smallest node it can reach.

    Links may repeat, and go either way; links of a node to itself and links with nulls are left out. A node without any
    other link is not in the result. No links: an empty table. Every round is a written table, and nothing but whether
    a round is needed comes to the driver.
    """
    chosen = links.where(f"`{a}` <> `{b}`").select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v"))
    edges = stored(chosen.mapInArrow(_contracted, "u long, v long").distinct(), "links")
    while _unfinished(edges):
        edges = stored(_small_star(_large_star(edges)), "links")
    return (
        edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        .union(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
    )
