"""Distributed union-find: connected components of an edge table by repeated hooking and contraction."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kinlink.llm.store import written

#: A contracted table of at most so many edges is finished by one task, which saves the rounds of the long tail.
FEW_EDGES = 10_000


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, parent) for the nodes of at most FEW_EDGES edges, by union-find; the parent is the smallest node."""
    above: dict[int, int] = {}

    def find(x: int) -> int:
        while above.setdefault(x, x) != x:
            above[x] = x = above[above[x]]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(a), find(b)
            above[max(a, b)] = min(a, b)
    nodes = list(above)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([find(x) for x in nodes], pa.int64())], ["node", "parent"])


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (a, b); the component is its smallest node.

    In each round every node hooks to the neighbour, or itself, that comes first in a random order
    of the round, and edges are rewritten between parents. The order makes the number of nodes fall
    by a constant factor in expectation, also for long chains. Smallest neighbours are partial aggregates. Edges are
    joined by their ends, so those of a hub meet at one key, which adaptive execution splits where it is skewed. Once few edges are
    left, one task finishes them. Null ends and loops are left out; an empty table gives no rows.
    Nodes are bigint.
    """
    edges = written(
        edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    parents: list[DataFrame] = []
    while left := edges.count():
        if left <= FEW_EDGES:
            parents.append(written(edges.repartition(1).mapInArrow(_finish, "node bigint, parent bigint"), "parents"))
            break
        turn = F.lit(len(parents))
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("near")).union(edges.select("b", "a"))
        first = both.groupBy("node").agg(F.min(F.struct(F.xxhash64(turn, "near").alias("h"), "near")).alias("first"))
        own = F.struct(F.xxhash64(turn, "node").alias("h"), F.col("node").alias("near"))
        parent = written(first.select("node", F.least("first", own)["near"].alias("parent")), "parents")
        parents.append(parent)
        edges = written(
            edges.join(parent.toDF("a", "pa"), "a").join(parent.toDF("b", "pb"), "b").where("pa != pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
    if not parents:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    root = parents[0]
    for parent in parents[1:]:
        root = (root.join(parent.toDF("parent", "next"), "parent", "left")
                .select("node", F.coalesce("next", "parent").alias("parent")))
    root = written(root, "roots")
    least = root.groupBy("parent").agg(F.min("node").alias("component"))
    return root.join(least, "parent").select("node", "component")
