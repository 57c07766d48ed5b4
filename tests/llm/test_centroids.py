"""Clustering by ns-bounds against rounds over all distances in plain Python."""

import hashlib

import duckdb
import numpy as np
import pytest
from compare import compare
from pyspark.sql import functions as F

from refmill.llm import centroids

SCHEMA = "vec_id bigint, embedding array<float>, label int, uid string, cluster string, ints int"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, "u", "c", 1) for i, v in rows], SCHEMA)


def vectors(seed, n, dim=64, spread=0.3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(11, dim))
    rows = [(i, (centres[i % 11] + spread * rng.normal(size=dim)).astype(np.float32).tolist()) for i in range(n)]
    rows += [(n + i, rows[5][1]) for i in range(30)] + [(3, rows[4][1]), rows[7], rows[7], (None, rows[1][1])]
    return rows + [(1000, None), (1001, []), (1002, [0.5] * (dim - 1)), (1003, [None] * dim), (1004, [float("nan")] * dim), (1005, [float("inf")] * dim), (1006, [0.0] * dim)]


def lloyd(rows, k=8, rounds=10, dim=64):
    """Sorted ``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)``."""
    kept = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in rows if v and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)]
    named = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest() if i is not None else "~", x) for i, x in kept)
    means = [x for _, x in named[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(means))

    for _ in range(rounds):
        groups = {}
        for _, x in kept:
            groups.setdefault(nearest(x)[1], []).append(x)
        means = [[sum(c) // len(groups[n]) for c in zip(*groups[n])] if n in groups else m for n, m in enumerate(means)]
    found = [(i, *nearest(x)[::-1]) for i, x in kept]
    inertia = {n: sum(d for _, c, d in found if c == n) for n in range(k)}
    names = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in means]
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), names[c]) for i, c, d in found), key=repr)


def query(spark, rows, path):
    table(spark, rows).write.parquet(f"{path}/embeddings.parquet")
    return centroids.op12_ns_bounds_centroids(spark, str(path))


def test_query_equals_plain_rounds(spark, tmp_path):
    rows = vectors(1, 300)
    assert sorted(map(tuple, query(spark, rows, tmp_path).collect()), key=repr) == lloyd(rows)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_fewer_vectors_than_centroids(spark, tmp_path, n):
    rows = [(i, [i / 7] * 64) for i in range(n)]
    assert sorted(map(tuple, query(spark, rows, tmp_path).collect()), key=repr) == lloyd(rows)


def test_large_components_stay_exact(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = [(i, ((rng.integers(-2, 3, 64) * 2.0**15) + rng.normal(size=64)).astype(np.float32).tolist()) for i in range(40)]
    assert sorted(map(tuple, query(spark, rows, tmp_path).collect()), key=repr) == lloyd(rows)
    huge = table(spark, [(1, [2.0**50] * 64), (2, [2.0**40] * 64), (3, [0.0] * 64), (4, [1.0] * 64)])
    found = centroids.cluster(centroids.stepped(huge, "vec_id", "embedding", 64, 1024), 2, 3, "3")
    assert {r.vec_id for r in found.assigned.collect()} == {2, 3, 4}


def test_bounds_decide_as_all_distances_do():
    rng = np.random.default_rng(2)
    for trial in range(30):
        x = rng.integers(-5, 6, (200, 3))
        x[::7] = x[0]
        history = [rng.integers(-5, 6, (6, 3))]
        cluster, squares, seen = np.full(200, -1), np.zeros((200, 6), np.int64), np.zeros((200, 6), np.int64)
        for _ in range(8):
            centroids.reassign(x, cluster, squares, seen, history, centroids.displacements(history))
            all_ = ((x[:, None] - history[-1][None]) ** 2).sum(axis=2)
            assert (cluster == all_.argmin(axis=1)).all()
            step = rng.integers(-1, 2, (6, 3)) * (rng.random((6, 1)) < 0.5)
            history = [*history, history[-1] + step]


def test_total_displacement_is_no_looser_than_summed_moves():
    rng = np.random.default_rng(3)
    history = [rng.integers(-9, 10, (4, 5))]
    for _ in range(6):
        history.append(history[-1] + rng.integers(-3, 4, (4, 5)))
    moved = centroids.displacements(history)
    for start in range(len(history)):
        summed = sum(np.sqrt(((b - a) ** 2).sum(axis=1)) for a, b in zip(history[start:], history[start + 1 :]))
        assert (moved[start] <= summed + 1e-9).all()


def test_fewer_distances_and_no_shuffle_in_a_round(spark):
    rows = table(spark, vectors(5, 2000, 64, 0.05))
    found = centroids.cluster(centroids.stepped(rows, "vec_id", "embedding", 64, 1024), 8, 10, "3")
    n = found.assigned.count()
    assert found.evaluations[0] == 8 * n and sum(found.evaluations[1:]) < 0.5 * 8 * n * len(found.evaluations[1:])
    vecs, _ = centroids._bucketed(spark.range(1000).select(F.col("id").alias("uid"), F.lit(1).alias("x")).repartition(4, "uid"), 4, "a")
    known, _ = centroids._bucketed(spark.range(1000).select(F.col("id").alias("uid"), F.lit(2).alias("y")).repartition(4, "uid"), 4, "b")
    joined = vecs.join(known.hint("shuffle_hash"), "uid")
    assert joined.count() == 1000 and "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()


def test_sql(spark, tmp_path):
    rows = [r for r in vectors(6, 120) if r[0] is not None]
    got = query(spark, rows, tmp_path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    assert compare(got, con, centroids.OP12_SQL) is None
