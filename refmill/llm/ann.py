"""Nearest neighbours by a block matrix join on 8-bit vectors.

Queries and candidates are dealt into blocks and every pair of blocks meets in one group.
There, products of 8-bit tiles give each pair's inner product up to an error bound that
follows from what rounding left over. Pairs whose upper bound reaches the k-th best lower
bound are computed anew in double precision and go to their query's heap.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_by_value
from .common import read_table
from .vectors import TOP, best, matrix, merge_tops, numbered, ranked, renewed, tops_table

ship_by_value(__name__)

BLOCK_ROWS = 4096
TILE_ROWS = 1024
PAIRS = 65_536  # pairs computed in double precision at a time


class Quantised:
    """8-bit codes of rows, with the scale, the length as coded and what rounding left over."""

    def __init__(self, rows: np.ndarray):
        self.scale = np.abs(rows).max(axis=1) / 127
        self.scale[self.scale == 0] = 1
        codes = np.rint(rows / self.scale[:, None])
        # Sums of 8-bit products are whole numbers; 24-bit floats hold them up to this width.
        self.codes = codes.astype(np.float32 if rows.shape[1] * 127 * 127 < 2**24 else np.float64)
        coded = codes * self.scale[:, None]
        self.norm = np.linalg.norm(rows, axis=1)
        self.coded_norm = np.linalg.norm(coded, axis=1)
        self.error = np.linalg.norm(rows - coded, axis=1)


def bounds(q: Quantised, c: Quantised, rows: slice, columns: slice) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of a tile and by how much they may be off."""
    estimate = (q.codes[rows] @ c.codes[columns].T).astype(np.float64)
    estimate *= q.scale[rows, None] * c.scale[None, columns]
    off = q.norm[rows, None] * c.error[None, columns] + q.error[rows, None] * c.coded_norm[None, columns]
    off += 1e-12 * q.norm[rows, None] * c.norm[None, columns]
    return estimate, off


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision, summed from the first component on."""
    total = np.zeros(len(a))
    for d in range(a.shape[1]):
        total += a[:, d] * b[:, d]
    return total


def _search_block(k: int):
    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        if not queries.num_rows or not candidates.num_rows:
            return tops_table([], pa.float64())
        q, c = matrix(queries), matrix(candidates)
        q_uid, c_uid = queries["uid"].to_numpy(), candidates["uid"].to_numpy()
        c_id = candidates["vec_id"].to_numpy()
        q8, c8 = Quantised(q), Quantised(c)
        heaps: list[list] = [[] for _ in range(len(q))]
        for top in range(0, len(q), TILE_ROWS):
            rows = slice(top, min(top + TILE_ROWS, len(q)))
            lowest = np.full((rows.stop - top, k), -np.inf)  # the k best lower bounds so far
            for left in range(0, len(c), TILE_ROWS):
                columns = slice(left, min(left + TILE_ROWS, len(c)))
                estimate, off = bounds(q8, c8, rows, columns)
                own = q_uid[rows, None] == c_uid[None, columns]
                lower = np.where(own, -np.inf, estimate - off)
                lowest = np.partition(np.concatenate([lowest, lower], axis=1), -k, axis=1)[:, -k:]
                i, j = np.nonzero(~own & (estimate + off >= lowest.min(axis=1)[:, None]))
                for at in range(0, len(i), PAIRS):
                    _push(heaps, k, i[at : at + PAIRS] + top, j[at : at + PAIRS] + left, q, c, c_id)
        ids = queries["vec_id"].to_pylist()
        found = [sorted(((-s, -v) for s, v in h)) for h in heaps]
        rows = [(int(u), n, [v for _, v in h], [-s for s, _ in h]) for u, n, h in zip(q_uid, ids, found) if h]
        return tops_table(rows, pa.float64())

    return run


def _push(heaps: list[list], k: int, i: np.ndarray, j: np.ndarray, q: np.ndarray, c: np.ndarray, c_id: np.ndarray) -> None:
    """Exact scores of the pairs ``(i, j)``, sorted by ``i``, into the heaps of their queries."""
    scores = inner(q[i], c[j])
    edges = np.flatnonzero(np.diff(i)) + 1
    for part in np.split(np.arange(len(i)), edges):
        if not len(part):
            continue
        heap = heaps[i[part[0]]]
        ids = c_id[j[part]]
        for at in best(scores[part], ids, k):
            entry = (float(scores[part[at]]), -int(ids[at]))
            if len(heap) < k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            else:
                break


def nearest(vectors: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vec_col: str = "embedding", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of largest inner product for each query row.

    ``is_query`` is a condition on ``vec_id``. Every other row is a candidate, copies of
    the query included; of equal scores the smaller id comes first. Null and zero vectors and
    those with null or non-finite components take no part; vectors of different length don't
    meet. Rows with a null id take no part either, as results could not name them.
    """
    rows = numbered(vectors.where(F.col(id_col).isNotNull()), id_col, vec_col, allow_zero=False)
    total, asked = rows.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    across, down = max(1, -(-total // block_rows)), max(1, -(-asked // block_rows))

    def block(n: int) -> Column:
        return F.pmod(F.xxhash64("uid"), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    cell, columns = ["dim", "down", "across"], ["dim", "uid", "vec_id", "vec"]
    queries = rows.where(is_query).select(*columns, block(down).alias("down"), every(across).alias("across"))
    candidates = renewed(rows).select(*columns, block(across).alias("across"), every(down).alias("down"))
    tops = queries.groupBy(*cell).cogroup(candidates.groupBy(*cell)).applyInArrow(_search_block(k), TOP.format(score="double"))
    return ranked(tops.groupBy("query_uid").applyInArrow(merge_tops(k, pa.float64()), TOP.format(score="double")))


def op7_block_matrix_join(spark, sf_dir):
    """The 20 nearest of every twentieth embedding among all."""
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)
