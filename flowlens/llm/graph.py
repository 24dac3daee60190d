"""Connected components of an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import stored

#: Edges that one task walks by itself, about, before all are walked together.
TASK_EDGES = 1 << 16


def _minima(edges: DataFrame) -> DataFrame:
    """Each edge (u, v) with the smallest neighbour of u, u itself included."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("_u"), F.least("_u", "m").alias("m"))
    return edges.join(least, F.col("u") == F.col("_u")).drop("_u")


def fingerprint(edges: DataFrame) -> tuple:
    """Number of distinct edges and 128 bits for all of them: one pass without an exchange of rows."""
    hashes = [F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", F.lit(1), "u"))]
    return tuple(edges.agg(F.count("*"), *hashes).first())


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's edges as one edge from each of its nodes to the smallest that those edges connect it with."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := above.setdefault(x, x)) != x:
            above[x] = x = above[y]
        return x

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x, y = top(u), top(v)
            above[max(x, y)] = min(x, y)
    hung = [(x, top(x)) for x in list(above) if above[x] != x]
    if hung:
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in hung], pa.int64()) for k in (0, 1)], names=["u", "v"])


def _labelled(stars: DataFrame) -> DataFrame:
    tops = stars.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(tops)


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that edges (u, v) of longs connect a node with; nodes without edges are left out.

    First each task walks its own edges; where they fit one task, that is all. Else large and small stars in turn: neighbours are
    hung on the smallest node they see until nothing moves. Each round's edges are written to the shared folder. Rounds grow with
    the logarithm of the nodes.
    """
    links = stored(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "edges")
    tasks = max(1, -(-links.count() // TASK_EDGES))
    stars = stored(links.coalesce(tasks).mapInArrow(_stars, "u long, v long"), "edges")
    if tasks == 1:
        return _labelled(stars)
    links = stored(stars.distinct(), "edges")
    before = fingerprint(links)
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _minima(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        held = _minima(large)
        small = held.select(F.col("v").alias("u"), F.col("m").alias("v")).union(held.select("u", F.col("m").alias("v")))
        links = stored(small.filter("u != v").distinct(), "edges")
        after = fingerprint(links)
        if after == before:
            return _labelled(links)
        before = after


def merged(groups: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, component) of `groups` after edges (u, v) between their components, or nodes in none, are added. Only
    components are walked again; the join has the nodes on its left side, so that a large component can be split."""
    newer = stored(components(edges), "groups")
    renamed = newer.select(F.col("node").alias("component"), F.col("component").alias("top"))
    moved = groups.join(renamed, "component", "left").select("node", F.coalesce("top", "component").alias("component"))
    return moved.union(newer.join(groups.select("node"), "node", "left_anti"))
