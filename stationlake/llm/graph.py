"""Connected components of an edge table: contraction in parts, then alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import forget, staged

#: Edges that one task contracts (16 bytes each).
PART = 1 << 20


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, least node of its component) with the components of the given ones."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[:len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while len(u):
        low, high = np.minimum(root[u], root[v]), np.maximum(root[u], root[v])
        u, v, low, high = (x[low < high] for x in (u, v, low, high))  # the others lie inside one tree
        np.minimum.at(root, high, low)
        while not np.array_equal(root, root[root]):
            root = root[root]
    below = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[below], nodes[root[below]]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One part's edges as a forest of stars."""
    forget()
    cols = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    if cols:
        a, b = forest(*(np.concatenate(c) for c in zip(*cols, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Join each node's neighbours (large: those above it, small: those below) to the least of them all."""
    if large:
        e = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = e.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
    out = e.join(least, F.col("a") == F.col("n"))
    if large:
        out = out.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = out.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("n").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame, name: str = "components", part: int = PART) -> DataFrame:
    """node, root (the least node of its component) of every node that has an edge to another one.

    ``edges`` has two long columns a, b, without nulls.  They are dealt evenly to parts of ``part`` edges, and each
    part is contracted to a forest by the task that reads it.  One part alone is then complete; the forests of
    several are joined by star rounds until nothing changes.  Every round is written to the shared folder; the driver
    sees two numbers a round.  A node's neighbours are aggregated and joined, never gathered.
    """
    own = staged(edges.select("a", "b").where("a <> b"), name)
    parts = max(1, -(-own.count() // part))
    now = staged(own.repartition(parts).mapInArrow(_contracted, "a long, b long"), name)
    last = None
    while parts > 1:
        now = staged(_star(_star(now, True), False), name)
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(mark) == last:
            break
        last = tuple(mark)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select("b", "b").distinct())
