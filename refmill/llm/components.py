"""Connected components of a table of edges, as Spark joins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_by_value, stage
from .common import column_list

ship_by_value(__name__)

_BATCH_EDGES = 500_000


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from every node of the given edges to the smallest node of its component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = smallest_reachable(len(nodes), at[: len(a)], at[len(a) :])
    other = root != np.arange(len(nodes))
    return nodes[root[other]], nodes[other]


def smallest_reachable(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` nodes the smallest one it is linked with over any number of edges."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        open_ = ra != rb
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            shorter = root[root]
            if (shorter == root).all():
                break
            root = shorter
    return root


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fewer edges that connect the same nodes, some batches at a time."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def out() -> pa.RecordBatch:
        low, high = forest(*[np.concatenate(c) for c in zip(*held)])
        return pa.RecordBatch.from_arrays([pa.array(low, pa.int64()), pa.array(high, pa.int64())], ["low", "high"])

    for batch in batches:
        if batch.num_rows:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        if sum(len(h[0]) for h in held) >= _BATCH_EDGES:
            yield out()
            held = []
    if held:
        yield out()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``(low bigint, high bigint)``: the smallest node reachable.

    Each round hooks every node's neighbours to the smallest node among them, in both
    directions, and contracts within tasks, until no edge changes. A node of many edges
    meets them in joins and partial aggregates only, never as one group in memory.
    """
    kind = "low bigint, high bigint"
    edges = stage(edges.select("low", "high").mapInArrow(_contract, kind).distinct())
    before = None
    while True:
        # every node to the smallest of its neighbours and itself
        ends = edges.select(F.col("high").alias("node"), F.col("low").alias("other")).unionByName(
            edges.select(F.col("low").alias("node"), F.col("high").alias("other"))
        )
        least = ends.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("least"))
        hooked = ends.join(least, "node").select(
            F.least("other", "least").alias("low"), F.greatest("other", "least").alias("high")
        )
        own = least.select(F.col("least").alias("low"), F.col("node").alias("high"))
        edges = stage(hooked.unionByName(own).where("low < high").mapInArrow(_contract, kind).distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("low", "high").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    # the edges are stars now: (root, node)
    roots = edges.select(F.col("low").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("high").alias("node"), F.col("low").alias("root")).unionByName(roots)
