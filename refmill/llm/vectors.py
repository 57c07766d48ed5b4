"""What the two vector searches share: usable rows, matrices of Arrow columns, merging of heaps."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_by_value, stage

ship_by_value(__name__)

#: nearest found so far of one query: equal-length lists, best first
TOP = "query_uid bigint, query_id bigint, vec_ids array<bigint>, scores array<{score}>"


def usable(vec: Column, allow_zero: bool) -> Column:
    """True for vectors without null or non-finite components, and other than zero unless allowed."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    some = F.exists(vec, lambda x: x != 0)
    return F.coalesce(vec.isNotNull() & (F.size(vec) > 0) & finite & (F.lit(allow_zero) | some), F.lit(False))


def numbered(rows: DataFrame, id_col: str, vec_col: str, allow_zero: bool) -> DataFrame:
    """``uid, vec_id, dim, vec`` of the usable rows, staged; ``uid`` tells repeated rows apart."""
    vec = F.col(vec_col)
    kept = rows.select(F.col(id_col).cast("bigint").alias("vec_id"), vec.alias("vec")).where(usable(F.col("vec"), allow_zero))
    return stage(kept.select(F.monotonically_increasing_id().alias("uid"), "vec_id", F.size("vec").alias("dim"), "vec"))


def renewed(df: DataFrame) -> DataFrame:
    """The same rows under new column identities, so that a frame can meet itself."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


def matrix(table: pa.Table, column: str = "vec") -> np.ndarray:
    """Rows of equal length as doubles."""
    n = table.num_rows
    flat = table[column].combine_chunks()
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` highest scores, ties to the smaller id."""
    return np.lexsort((ids, -scores))[:k]


def merge_tops(k: int, score_type: pa.DataType):
    """Heap-merge of a query's sorted lists into one of at most ``k``."""

    def run(table: pa.Table) -> pa.Table:
        first = table.slice(0, 1).to_pylist()[0]
        lists = [
            [(-s, v) for v, s in zip(ids, scores)]
            for ids, scores in zip(table["vec_ids"].to_pylist(), table["scores"].to_pylist())
        ]
        top = [pair for pair, _ in zip(heapq.merge(*lists), range(k))]
        return pa.table(
            {
                "query_uid": pa.array([first["query_uid"]], pa.int64()),
                "query_id": pa.array([first["query_id"]], pa.int64()),
                "vec_ids": pa.array([[v for _, v in top]], pa.list_(pa.int64())),
                "scores": pa.array([[-s for s, _ in top]], pa.list_(score_type)),
            }
        )

    return run


def tops_table(rows: list[tuple], score_type: pa.DataType) -> pa.Table:
    columns = list(zip(*rows)) or [[], [], [], []]
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(score_type)]
    return pa.table(
        {n: pa.array(list(c), t) for n, c, t in zip(("query_uid", "query_id", "vec_ids", "scores"), columns, kinds)}
    )


def ranked(tops: DataFrame) -> DataFrame:
    """One row per query and rank."""
    return tops.select(
        "query_id", F.posexplode(F.arrays_zip("vec_ids", "scores")).alias("pos", "found")
    ).select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("found.vec_ids").alias("vec_id"), F.col("found.scores").alias("score"))
