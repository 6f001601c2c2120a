"""Connected components of an edge table, by hooking and contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lectern.llm.common import MANY, checkpoint, tidy

#: Edges that one task joins by itself, some 100 MB.
FEW = 1 << 19


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For all ends of the edges the least one of their component."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x, y = root(a), root(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
    nodes = np.array(list(parent), dtype=np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array([root(x) for x in nodes.tolist()], pa.int64())], names=["node", "up"])


def connected_components(edges: DataFrame, few: int = FEW) -> DataFrame:
    """``id`` and ``component`` (the least id reachable) of all ids in ``edges`` (longs a, b).

    A round points each node to whichever of itself and its neighbours has the
    least hash, and replaces the ends of all edges by what they point to. Hashes
    make about a third of a path's nodes go on, where least ids would shorten it
    by one node a round. Minima are taken before the shuffle, so a node with very
    many neighbours costs no task more. Once no more than ``few`` edges are left,
    one task joins them.
    """
    left = checkpoint(edges.select("a", "b").filter("a <> b").distinct())
    number = left.count()
    if number <= few:
        return checkpoint(left.coalesce(1).mapInArrow(tidy(_joined, MANY), "node long, up long").toDF("id", "component"))
    labels = checkpoint(left.select(F.explode(F.array("a", "b")).alias("id")).distinct().withColumn("top", F.col("id")))
    ranked = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("node"))
    while number:
        if number <= few:
            parent = left.coalesce(1).mapInArrow(tidy(_joined, MANY), "node long, up long")
        else:
            both = left.select("a", "b").union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
            least = both.groupBy("a").agg(F.min(ranked("b")).alias("low"))
            parent = least.select(F.col("a").alias("node"), F.least(ranked("a"), "low")["node"].alias("up"))
        parent = checkpoint(parent)
        labels = checkpoint(labels.join(parent, F.col("top") == F.col("node"), "left").select("id", F.coalesce("up", "top").alias("top")))
        if number <= few:
            break
        a, b = parent.toDF("a", "x"), parent.toDF("b", "y")
        left = checkpoint(left.join(a, "a").join(b, "b").filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        number = left.count()
    first = labels.groupBy("top").agg(F.min("id").alias("component"))
    return checkpoint(labels.join(first, "top").select("id", "component"))
