"""Both vector searches against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from refmill.llm import ann, pivots

SCHEMA = "vec_id bigint, embedding array<float>, label int, uid string, dim string"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, "u", "d") for i, v in rows], SCHEMA)


def vectors(seed, n, dim=8, copies=40):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, dim))
    rows = [(i, (centres[i % 4] + 0.3 * rng.normal(size=dim)).astype(np.float32).tolist()) for i in range(n)]
    rows += [(n + i, rows[5][1]) for i in range(copies)]  # ties
    rows += [(20, rows[3][1]), (20, rows[3][1]), (7, rows[3][1])]  # repeated ids and rows
    rows += [(1000, None), (1001, []), (1020, [None] * dim), (1040, [float("nan")] * dim), (1060, [float("inf")] * dim), (None, rows[1][1])]
    return rows


def brute(rows, every, k, score, allow_zero):
    ok = [(i, v) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and (allow_zero or any(v))]
    out = []
    for n, (qid, q) in enumerate(ok):
        if qid % every:
            continue
        found = sorted((-score(q, v), i) for m, (i, v) in enumerate(ok) if m != n and len(v) == len(q))[:k]
        out += [(qid, r, i, -s) for r, (s, i) in enumerate(found, 1)]
    return sorted(out)


def in_order(q, v):
    total = 0.0
    for a, b in zip(q, v):
        total += a * b
    return total


def whole(q, v):
    f = lambda x: int(np.floor(1024 * float(x)))
    return sum(f(a) * f(b) for a, b in zip(q, v))


@pytest.mark.parametrize("block_rows", [16, 4096])
def test_block_join_equals_brute_force(spark, block_rows):
    rows = vectors(1, 300) + [(2000, [0.0] * 8), (2020, [1.0, 2.0]), (2021, [1.0, 3.0])]
    got = ann.nearest(table(spark, rows), F.col("vec_id") % 20 == 0, 5, block_rows=block_rows)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, 20, 5, in_order, False)


@pytest.mark.parametrize("block_rows", [16, 4096])
def test_pivot_search_equals_brute_force(spark, block_rows):
    rows = vectors(2, 300) + [(2000, [0.0] * 8), (2001, [-3.0] * 8), (2020, [1.0, 2.0]), (2021, [1.0, 3.0])]
    got = pivots.highest_products(table(spark, rows), F.col("vec_id") % 20 == 0, 5, pivots=6, sample_rows=50, block_rows=block_rows)
    assert sorted(map(tuple, got.collect())) == brute(rows, 20, 5, whole, True)


def test_fewer_candidates_than_asked_for(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5])]
    near = ann.nearest(table(spark, rows), F.col("vec_id") == 0, 20)
    assert [tuple(r) for r in near.orderBy("rank").collect()] == [(0, 1, 1, 0.5), (0, 2, 2, 0.5)]
    high = pivots.highest_products(table(spark, rows), F.col("vec_id") == 0, 10)
    assert [(r.rank, r.vec_id) for r in high.orderBy("rank").collect()] == [(1, 1), (2, 2)]


@pytest.mark.parametrize("rows", [[], [(1, None)]])
def test_empty_tables(spark, rows):
    assert ann.nearest(table(spark, rows), F.col("vec_id") % 20 == 0, 5).count() == 0
    assert pivots.highest_products(table(spark, rows), F.col("vec_id") % 20 == 0, 5).count() == 0


def test_error_bound_holds():
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=(50, 33)), rng.normal(size=(70, 33)) * 10
    estimate, off = ann.bounds(ann.Quantised(a), ann.Quantised(b), slice(0, 50), slice(0, 70))
    assert (np.abs(estimate - a @ b.T) <= off).all()
