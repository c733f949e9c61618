"""Connected components of links between 64-bit nodes: union-find in every task, then stars over shuffles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kwarta.llm.shared import FEW, remove, told, written


def unite(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union-find over links: every node that is not its set's smallest, with the smallest."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = list(range(len(nodes)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in zip(at[: len(a)].tolist(), at[len(a) :].tolist(), strict=True):
        i, j = find(i), find(j)
        if i != j:
            parent[max(i, j)] = min(i, j)
    root = np.array([find(i) for i in range(len(nodes))], np.int64)
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch of links becomes stars of the same components."""
    for batch in batches:
        a, b = unite(batch.column(0).to_numpy(), batch.column(1).to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _smallest(links: DataFrame) -> DataFrame:
    return links.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))


def _large_star(links: DataFrame, total: int) -> DataFrame:
    """Every neighbour above a node is linked to the node's smallest neighbour (or the node) instead."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = _smallest(both).select("a", "n", F.least("a", "m").alias("m"))
    return told(both, near, "a", "n", 2 * total, "m").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame, total: int) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    joined = told(links, _smallest(links), "a", "n", total, "m")
    return joined.select(F.explode(F.array(
        F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
    )).alias("l")).select("l.a", "l.b").where("a <> b")


def components(links: DataFrame) -> tuple[DataFrame, str]:
    """(a, b) links to a table (node, root): every node that is not its component's smallest. Also its path.

    Self-links are ignored; without links the table is empty. Nothing is gathered in one task or the driver: a
    node's smallest neighbour is found by partial minima, and where a node has many links it is broadcast to them.
    """
    spark = links.sparkSession
    ordered = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    stars, path = written(ordered.mapInArrow(_local, "a long, b long").distinct(), "stars")
    state = None
    while True:
        now = stars.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == state:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("root")), path
        state, old = now, path
        large, used = _large_star(stars, now[0]), [old]
        if now[0] > FEW:  # it is read twice
            large, between = written(large, "stars")
            used.append(between)
        stars, path = written(_small_star(large, now[0]).distinct(), "stars")
        remove(spark, used)
