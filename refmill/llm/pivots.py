"""Exact search of the highest inner products with a pivot-distance index.

Every vector ``v`` gets one more component, ``sqrt(M² - |v|²)`` with ``M`` the greatest
length of all. In that space the squared distance of a query (with 0 there) is
``|q|² + M² - 2 q·v``, so the highest products are the nearest points and distances obey
the triangle inequality. Vectors are keyed by nearest pivot and distance to it and stored
sorted by both, in blocks: annuli of a pivot. A query searches the annulus nearest to it,
then wider rings of them. An annulus ``[low, high]`` of a pivot at distance ``d`` holds
nothing nearer than ``max(d - high, low - d)``; when that exceeds the k-th best distance
found, it is never read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship_by_value, stage
from .common import read_table
from .vectors import TOP, best, matrix, merge_tops, numbered, ranked, renewed, tops_table

ship_by_value(__name__)

PIVOTS = 64
SAMPLE_ROWS = 4096  # rows on which pivots are fitted; the index holds every row
BLOCK_ROWS = 4096
RINGS = (1, 8, None)  # annuli searched up to each round, the nearest first; at last all that may matter


def fit_pivots(rows: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Centres of the sample by Lloyd's iteration from evenly spaced rows."""
    pivots = rows[np.linspace(0, len(rows) - 1, min(k, len(rows))).astype(int)]
    for _ in range(rounds):
        near = distances(rows, pivots).argmin(axis=1)
        sums, counts = np.zeros_like(pivots), np.bincount(near, minlength=len(pivots))
        np.add.at(sums, near, rows)
        pivots = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], pivots)
    return pivots


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squared = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(squared, 0))


def lifted(rows: np.ndarray, greatest: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(greatest - (rows * rows).sum(axis=1), 0))
    return np.hstack([rows, rest[:, None]])


def _key(pivots: np.ndarray, greatest: float, dim: int):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            rows = matrix(table)
            near = distances(lifted(rows, greatest), pivots)
            flat = distances(np.hstack([rows, np.zeros((len(rows), 1))]), pivots)  # as a query
            arrays = [
                *batch.columns,
                pa.array(near.argmin(axis=1), pa.int32()),
                pa.array(near.min(axis=1), pa.float64()),
                pa.array(list(flat), pa.list_(pa.float64())),
            ]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, "pivot", "distance", "to_pivots"])

    return run


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Whole-number inner products; doubles are exact as long as no sum can leave 53 bits."""
    if not len(c):
        return np.zeros(0, np.int64)
    if np.abs(q).max() * np.abs(c).max() * len(q) < 2**53:
        return (c @ q).astype(np.int64)
    return c.astype(np.int64) @ q.astype(np.int64)


def _search_annulus(k: int):
    def run(routes: pa.Table, block: pa.Table) -> pa.Table:
        if not routes.num_rows or not block.num_rows:
            return tops_table([], pa.int64())
        q, c = matrix(routes), matrix(block)
        from_pivot = block["distance"].to_numpy()
        order = np.argsort(from_pivot, kind="stable")
        c, from_pivot = c[order], from_pivot[order]
        uid, ids = block["uid"].to_numpy()[order], block["vec_id"].to_numpy()[order]
        rows = []
        keys = zip(*[routes[n].to_pylist() for n in ("query_uid", "query_id", "to_pivot", "reach")])
        for vec, (query_uid, query_id, at, reach) in zip(q, keys):
            low, high = np.searchsorted(from_pivot, at - reach), np.searchsorted(from_pivot, at + reach, side="right")
            scores = _products(vec, c[low:high])
            other = uid[low:high] != query_uid
            scores, found = scores[other], ids[low:high][other]
            top = best(scores, found, k)
            if len(top):
                rows.append((query_uid, query_id, found[top].tolist(), scores[top].tolist()))
        return tops_table(rows, pa.int64())

    return run


def highest_products(
    vectors: DataFrame,
    is_query: Column,
    k: int,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    pivots: int = PIVOTS,
    sample_rows: int = SAMPLE_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest inner products for each query row, exactly.

    Components are taken as ``floor(1024 x)``. ``is_query`` is a condition on ``vec_id``;
    all rows but the query's own are candidates, copies of it included, ties go to the smaller
    id. Null vectors, those with null or non-finite components and rows with a null id take no
    part; zero vectors do. Vectors of different length don't meet.
    """
    rows = numbered(vectors.where(F.col(id_col).isNotNull()), id_col, vec_col, allow_zero=True)
    rows = rows.withColumn("vec", F.transform("vec", lambda x: F.floor(x.cast("double") * 1024).cast("double")))
    found = None
    for dim in sorted(r.dim for r in rows.select("dim").distinct().collect()):
        part = _search_dim(rows.where(F.col("dim") == dim), is_query, k, dim, pivots, sample_rows, block_rows)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = rows.sparkSession.createDataFrame([], TOP.format(score="bigint"))
    return ranked(found)


def _search_dim(rows: DataFrame, is_query: Column, k: int, dim: int, pivots: int, sample_rows: int, block_rows: int) -> DataFrame:
    length = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)
    total, asked, greatest = rows.agg(F.count("*"), F.count(F.when(is_query, 1)), F.max(length)).first()
    sample = rows.orderBy(F.xxhash64("uid"), "uid").limit(sample_rows).select("vec").collect()
    centres = fit_pivots(lifted(np.array([r.vec for r in sample], float), greatest), pivots)
    keyed = rows.mapInArrow(
        _key(centres, greatest, dim), "uid bigint, vec_id bigint, dim int, vec array<double>, pivot int, distance double, to_pivots array<double>"
    )
    blocks = -(-total // block_rows)
    index = stage(
        keyed.repartitionByRange(blocks, "pivot", "distance", "uid").withColumn("block", F.spark_partition_id())
    )
    annuli = index.groupBy("pivot", "block").agg(F.min("distance").alias("low"), F.max("distance").alias("high"))
    asking = index.where(is_query).select(
        F.col("uid").alias("query_uid"), F.col("vec_id").alias("query_id"), "vec", length.alias("squared"), "to_pivots"
    )
    visits = asking.select("query_uid", F.posexplode("to_pivots").alias("pivot", "to_pivot")).join(annuli, "pivot")
    gap = F.greatest(F.lit(0.0), F.col("to_pivot") - F.col("high"), F.col("low") - F.col("to_pivot"))
    nearest_first = Window.partitionBy("query_uid").orderBy("gap", "to_pivot", "block")
    visits = stage(visits.select("query_uid", "pivot", "block", "to_pivot", gap.alias("gap")).withColumn("turn", F.row_number().over(nearest_first)))

    groups = max(1, -(-asked // block_rows))  # of queries that meet a block together
    group = F.pmod(F.xxhash64("query_uid"), F.lit(groups)).cast("int")
    spread = renewed(index).select(
        "uid", "vec_id", "vec", "distance", "pivot", "block", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("queries")
    )
    key = ["pivot", "block", "queries"]
    done, tops = 0, None
    for ring in RINGS:
        due = visits.where(F.col("turn") > done)
        if ring:
            due = due.where(F.col("turn") <= ring)
        ask = asking.drop("to_pivots")
        if tops is None:
            ask = ask.withColumn("reach", F.lit(float("inf")))
        else:
            last = F.when(F.size("scores") >= k, F.element_at("scores", k))
            reach = F.sqrt(F.greatest(F.lit(0.0), F.col("squared") + greatest - 2 * F.col("last")))
            ask = ask.join(tops.select("query_uid", last.alias("last")), "query_uid", "left")
            # rounding of a distance is far below this margin; a wider reach only reads more
            ask = ask.withColumn("reach", F.when(F.col("last").isNull(), float("inf")).otherwise(reach * (1 + 1e-9) + 1e-6))
        routes = due.join(ask, "query_uid").where(F.col("gap") <= F.col("reach")).withColumn("queries", group)
        routes = routes.select(*key, "query_uid", "query_id", "vec", "to_pivot", "reach")
        found = routes.groupBy(*key).cogroup(spread.groupBy(*key)).applyInArrow(_search_annulus(k), TOP.format(score="bigint"))
        both = found if tops is None else found.unionByName(tops)
        tops = stage(both.groupBy("query_uid").applyInArrow(merge_tops(k, pa.int64()), TOP.format(score="bigint")))
        done = ring
    return tops


def op8_pivot_distance(spark, sf_dir):
    """The 10 highest integer inner products of every hundredth embedding among all."""
    return highest_products(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)
