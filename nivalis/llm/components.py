"""Connected components of a graph given as an edge table: forests of the tasks, then alternating stars.

Every node of the edge table gets the smallest node it can reach.  Each task
first replaces its edges, up to ``EDGES`` at a time, by a forest of stars that
connects the same nodes (an edge from every node to the smallest one it
reaches there), so most of a component is found before anything is shuffled.
What the forests still leave apart is brought together in rounds: each node's
larger neighbours are tied to the smallest node next to it (large star), then
its smaller neighbours and itself are tied to the smallest of them (small
star), then the forests again; components become stars in O(log^2 n) rounds.  A
hub's neighbours are reduced to their minimum by a partial aggregation; they
meet that minimum in a join on the hub, which adaptive skew handling splits
where it is large.  Every round is written to the shared folder, so
lineage stays short and a lost executor costs its running tasks only.  The
rounds end when the edges are stars: no node has edges to two smaller nodes,
and none has edges on both sides, which one aggregation over the nodes tells.
The same aggregation is the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions_for, stage

#: Edges in one partition of a round, and of one forest.
EDGES = 200_000


def forest_of(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node it reaches) of all nodes of the edges but those smallest ones."""
    nodes, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a):]
    root = np.arange(len(nodes))
    while True:
        rx, ry = root[x], root[y]
        apart = rx != ry
        if not apart.any():
            break
        x, y, rx, ry = x[apart], y[apart], rx[apart], ry[apart]
        np.minimum.at(root, np.maximum(rx, ry), np.minimum(rx, ry))  # a root goes below a smaller one
        while (root[root] != root).any():
            root = root[root]
    leaf = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[leaf], nodes[root[leaf]]


def forests(edges: DataFrame) -> DataFrame:
    """Edges (a > b) that connect what ``edges`` (a, b) connect: a forest of stars per ``EDGES`` edges of a task."""
    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            a, b = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b"))
            held.append((a, b))
            size += len(a)
            if size >= EDGES:
                # What is left of the chunk stays for the next one where it has shrunk enough to be worth it.
                a, b = forest_of(*(np.concatenate(c) for c in zip(*held)))
                held, size = [(a, b)], len(a)
                if 2 * size > EDGES:
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
                    held, size = [], 0
        if held:
            a, b = forest_of(*(np.concatenate(c) for c in zip(*held)))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return edges.select("a", "b").mapInArrow(run, "a long, b long")


def by_node(edges: DataFrame) -> DataFrame:
    """node, lo, hi (smallest and largest of its smaller neighbours, null for none), above (whether it has larger ones)."""
    ends = (edges.select(F.col("a").alias("node"), F.col("b").alias("smaller"), F.lit(False).alias("above"))
            .unionByName(edges.select(F.col("b").alias("node"), F.lit(None).cast("long").alias("smaller"), F.lit(True).alias("above"))))
    return ends.groupBy("node").agg(F.min("smaller").alias("lo"), F.max("smaller").alias("hi"), F.max("above").alias("above"))


def components(edges: DataFrame) -> DataFrame:
    """node, component for every node of ``edges`` (a, b); repeated edges do no harm, loops are left out."""
    spark = edges.sparkSession
    edges = stage(edges.select("a", "b").filter("a <> b"), "component_edges")
    n = edges.count()
    with partitions_for(spark, 2 * n, EDGES) as files:
        # Tasks of the files' small pieces together: a forest over more edges leaves less to the rounds.
        edges = stage(forests(edges.coalesce(1 + n // EDGES)), "component_forests")
        while True:
            nodes = stage(by_node(edges), "components", files)
            if nodes.filter("lo <> hi or lo is not null and above").isEmpty():
                return nodes.select("node", F.coalesce("lo", "node").alias("component"))
            edges = star_round(edges, files)


def star_round(edges: DataFrame, files: int) -> DataFrame:
    """The edges after a large and a small star."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    large = (both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
             .filter("a <> b").distinct())
    large = stage(large, "large_star", files)
    smallest = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
    return stage(forests(small.unionByName(smallest.select("a", F.col("m").alias("b"))).coalesce(files)), "small_star")
