"""Connected components of a graph whose edges are rows.

Parts of at most PART edges are contracted in tasks: a part's components become stars around their least nodes. If there
is one part, that is the answer. Otherwise contraction alternates with distributed rounds, which tie each node's
neighbours to the least of them (alternating large and small stars), until no edge changes; these need no list of a
node's neighbours, so a node with a third of all edges costs a skewed join and not a task.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import written

PART = 1_000_000


def least_labels(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the edges and the least node of each one's component."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while len(x):
        low, high = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
        differ = low != high
        if not differ.any():
            break
        x, y, low, high = x[differ], y[differ], low[differ], high[differ]
        np.minimum.at(root, high, low)  # hang the larger root below the smaller
        while True:  # and every node below its root
            above = root[root]
            if (above == root).all():
                break
            root = above
    return nodes, nodes[root]


def _contract(batches):
    a, b = [], []
    for batch in batches:
        a.append(np.asarray(batch.column("a")).astype(np.int64))
        b.append(np.asarray(batch.column("b")).astype(np.int64))
    if a:
        node, root = least_labels(np.concatenate(a), np.concatenate(b))
        tied = node != root
        yield pa.RecordBatch.from_arrays([pa.array(node[tied]), pa.array(root[tied])], names=["a", "b"])


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours (the larger ones, or the smaller ones and itself) are tied to the least of all of them."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    if large:
        tied = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        tied = both.where("b < a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        tied = tied.unionByName(least.select("a", F.col("m").alias("b")))
    return tied.where("a != b").distinct()


def components(edges: DataFrame, name: str = "components", part: int = PART) -> DataFrame:
    """(node, root) for each node of the edges (a, b); root: the least node of its component. Only counts come to the
    driver."""
    edges = written(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    seen = None
    while True:
        parts = max(1, math.ceil(edges.count() / part))
        dealt = edges.coalesce(1) if parts == 1 else edges.repartition(parts)
        edges = written(dealt.mapInArrow(_contract, "a long, b long"), name)
        if parts == 1:
            break
        edges = written(_stars(_stars(edges, large=True), large=False), name)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
