"""Connected components of an edge table: contraction inside tasks, alternating star contraction between them.

A task replaces each block of at most ``BLOCK_EDGES`` edges by stars with the
same components, so most links shrink where they are read.  Edges that fit one
block are done then.  More of them go through rounds that link every node to
the smallest neighbour it knows (large star, then small star), with joins and
partial minima only, and contract again: a node of any degree is never gathered
into one row, and adaptive execution may split its join.  Every round is
written to the shared folder; the rounds needed grow with the logarithm of a
component's diameter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import Workspace

MAX_ROUNDS = 60
BLOCK_EDGES = 1 << 20  # 16 MB of ids: what a task holds at a time


def smallest_reachable(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct nodes of the edges (u, v) and the smallest node each can reach."""
    names, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    ends = ends.reshape(2, -1)
    root = np.arange(len(names))
    while True:
        low, high = np.sort(root[ends], axis=0)
        if (low == high).all():
            return names, names[root]
        np.minimum.at(root, high, low)
        while (root != (above := root[root])).any():
            root = above


def _contracted(edges: DataFrame, block: int, roots: bool = False) -> DataFrame:
    """Stars (u, v), v the smallest node, with the components of each block of edges; ``roots`` adds (v, v)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        count = 0

        def stars() -> pa.RecordBatch:
            node, least = smallest_reachable(*np.concatenate(held, axis=1))
            if not roots:
                node, least = node[node != least], least[node != least]
            return pa.RecordBatch.from_arrays([pa.array(node), pa.array(least)], names=["u", "v"])

        for batch in batches:
            held.append(np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()]))
            count += batch.num_rows
            if count >= block:
                yield stars()
                held, count = [], 0
        if count:
            yield stars()

    return edges.select("u", "v").mapInArrow(rows, "u long, v long")


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (u, v).  Large: neighbours above u move to u's smallest neighbour; small: u and those below do."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = both.join(least, "u")
    moved = joined.where("v > u" if large else "v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        moved = moved.unionByName(least.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def components(edges: DataFrame, work: Workspace, label: str = "cc", block: int = BLOCK_EDGES) -> DataFrame:
    """(node, component) of every node of ``edges`` (columns a, b); component is the smallest node reachable."""
    start = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v")
    current = work.save(_contracted(start, block), f"{label}-0")
    state = None
    for i in range(1, MAX_ROUNDS + 1):
        total = current.agg(
            F.count("*").alias("n"),
            F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0)).alias("h"),
        ).first()
        if total["n"] < block:  # all in one block
            return _contracted(current.coalesce(1), block, roots=True).toDF("node", "component")
        if (total["n"], total["h"]) == state:
            break
        state = (total["n"], total["h"])
        current = work.save(_contracted(_star(_star(current, True), False), block), f"{label}-{i}")
        work.drop(f"{label}-{i - 1}")
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
