"""Connected components of a distributed edge list.

Star contraction in two alternating steps (large stars, then small stars), which takes a
number of rounds that grows with the logarithm of the longest path. Each step reads a
written copy of the edges and of the smallest neighbours, so that a lost executor costs
one step, and so that Spark can split the partition of a node with very many links.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtally.session import staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges: (u, v) with u > v, distinct. One contraction step, in the same form."""
    if large:
        # each node's smallest neighbour, itself included; its larger neighbours move there
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        least = staged(least.select(F.col("u").alias("node"), "m"), "least")
        moved = edges.join(least, F.col("v") == F.col("node")).select("u", F.col("m").alias("v"))
    else:
        # each node's smaller neighbours, and the node itself, move to the smallest of them
        least = staged(edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), "m"), "least")
        moved = edges.join(least, F.col("u") == F.col("node")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = moved.union(least.select(F.col("node").alias("u"), F.col("m").alias("v")))
    return staged(moved.where(F.col("u") != F.col("v")).distinct(), "stars")


def _state(edges: DataFrame) -> tuple:
    """Count and order-free hash of the edges: unchanged when the contraction has ended."""
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(a, b) links of longs -> (node, root) for every node that has a link to another.

    root is the smallest node reachable. Repeated links, links in both directions and
    links of a node to itself do no harm; without links the result is empty.
    """
    pairs = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    current = staged(pairs.distinct(), "links")
    state = _state(current)
    while state[0]:
        current = _star(_star(current, large=True), large=False)
        before, state = state, _state(current)
        if state == before:
            break
    nodes = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(nodes.select(F.col("root").alias("node"), "root").distinct())


def spanning_links(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest reachable node) that connect what the links a-b connect."""
    nodes, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = inverse[: len(a)], inverse[len(a) :]
    root = np.arange(len(nodes))
    while True:
        before = root.copy()
        low = np.minimum(root[left], root[right])
        np.minimum.at(root, root[left], low)
        np.minimum.at(root, root[right], low)
        np.minimum.at(root, left, low)
        np.minimum.at(root, right, low)
        root = root[root]
        if np.array_equal(root, before):
            break
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]
