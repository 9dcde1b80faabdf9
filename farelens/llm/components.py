"""Connected components of an edge table by alternating stars, without a limit on a component's size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelens.session import materialize

EDGE = "a bigint, b bigint"


def local_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the edges and, for each, the smallest node its edges here connect it with."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        for side in (root[x], root[y], x, y):
            np.minimum.at(new, side, low)
        while (jump := new[new]).tobytes() != new.tobytes():
            new = jump
        if np.array_equal(new, root):
            return nodes, nodes[root]
        root = new


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the edges of each batch by one edge from every node to the smallest it is connected with."""
    for batch in batches:
        if batch.num_rows:
            nodes, roots = local_roots(batch.column(0).to_numpy(), batch.column(1).to_numpy())
            keep = nodes != roots
            yield pa.RecordBatch.from_arrays([pa.array(nodes[keep]), pa.array(roots[keep])], ["a", "b"])


def connected(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node``, ``component_id`` (its smallest node) for every node of ``edges`` (a, b); self-loops and repeats allowed.

    Each round links every larger neighbour of a node to the smallest one (large star), then every smaller one
    (small star), and stores the result. Neighbours are never gathered: only their minimum is, which is combined
    before the shuffle. The rounds grow with the logarithm of the longest path. An empty table gives no rows.
    """
    # Both orders: local stars shorten the paths before the first shuffle.
    edges = edges.select(F.col("a").cast("bigint"), F.col("b").cast("bigint")).filter("a is not null and b is not null")
    loops = edges.filter("a = b").select("a", "b").distinct()
    edges = materialize(edges.filter("a <> b").mapInArrow(_stars, EDGE).distinct(), f"{name}-edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a <> b")
        large = large.distinct()
        # Now a > b in every edge; each a keeps its smallest neighbour and passes it on to the others.
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.when(F.col("b") == F.col("low"), F.col("a")).otherwise(F.col("b")).alias("a"), "low")
        small = small.select("a", F.col("low").alias("b")).filter("a <> b").distinct()
        edges = materialize(small, f"{name}-round")
        after = edges.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("digest"), F.countDistinct("a").alias("froms")
        ).first()
        if before == after and after["n"] == after["froms"]:
            break
        before = after
    labels = edges.select(F.col("a").alias("node"), F.col("b").alias("component_id"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component_id")).distinct()
    found = labels.unionByName(roots)
    alone = loops.select(F.col("a").alias("node"), F.col("b").alias("component_id")).join(found.select("node"), "node", "left_anti")
    return found.unionByName(alone)
