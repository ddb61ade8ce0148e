"""Connected components of a graph, by Spark joins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.llm.storage import stored

#: So many links a task connects by itself: 2 MB of them. It changes what components cost, never which they are.
LINKS_A_TASK = 1 << 17


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it is linked to by any path, for all nodes in links.

    ``links`` has columns ``x`` and ``y``. Tasks first put in place of the links they hold the fewest
    that connect the same nodes; what is left of a graph of few links is one task's, and done. In
    others, each round, every node is linked to the smallest of its neighbours instead of to all of
    them, first by its larger neighbours, then by its smaller ones, until no link changes; rounds
    grow with the logarithm of the longest path. A node with very many neighbours costs one row
    each, dealt by node after a partial minimum.
    """
    edges = stored(_connected(links.filter("x <> y")), "links")
    if edges.count() <= LINKS_A_TASK:
        edges = stored(_connected(edges.coalesce(1)), "links")
    else:
        edges = _starred(edges)
    roots = edges.select(F.col("x").alias("node"), F.col("y").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _connected(links: DataFrame) -> DataFrame:
    """Links from each node to the smallest one that it is linked to by links of the same task, of
    ``LINKS_A_TASK`` at a time."""

    def connect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[np.ndarray] = []
        gathered = 0
        for whole in batches:
            for at in range(0, whole.num_rows, LINKS_A_TASK):
                batch = whole.slice(at, LINKS_A_TASK)
                if gathered + batch.num_rows > LINKS_A_TASK:
                    yield _forest(pending)
                    pending, gathered = [], 0
                pending.append(np.stack([batch.column(end).to_numpy() for end in ("x", "y")]))
                gathered += batch.num_rows
        if pending:
            yield _forest(pending)

    return links.select("x", "y").mapInArrow(connect, "x bigint, y bigint")


def _forest(links: list[np.ndarray]) -> pa.RecordBatch:
    """From each node but the smallest ones a link to the smallest that it reaches."""
    nodes, ends = np.unique(np.concatenate(links, axis=1), return_inverse=True)
    one, two = ends.reshape(2, -1)
    root = np.arange(len(nodes))
    while len(one):
        # Roots go below smaller ones, so that in two turns each has met another.
        np.minimum.at(root, np.maximum(one, two), np.minimum(one, two))
        while (root[root] != root).any():
            root = root[root]
        one, two = root[one], root[two]
        apart = one != two
        one, two = one[apart], two[apart]
    linked = root != np.arange(len(nodes))
    found = [nodes[linked], nodes[root[linked]]]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], ["x", "y"])


def _starred(edges: DataFrame) -> DataFrame:
    """Links from each node to the smallest one of its component, by rounds."""
    before = None
    while True:
        edges = stored(_small_star(_large_star(edges)), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first()
        if now == before:
            return edges
        before = now


def _down(links: DataFrame) -> DataFrame:
    """Each link once, from its larger node to its smaller one."""
    larger, smaller = F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")
    return links.filter("x <> y").select(larger, smaller).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
    least = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
    joined = both.join(least, "x").filter("y > x")
    return _down(joined.select(F.col("y").alias("x"), F.col("m").alias("y")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("x").agg(F.min("y").alias("m"))
    joined = edges.join(least, "x")
    linked = joined.select(F.col("y").alias("x"), F.col("m").alias("y"))
    return _down(linked.unionByName(least.select("x", F.col("m").alias("y"))))
