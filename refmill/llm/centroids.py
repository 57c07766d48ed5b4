"""Centroid clustering of integer vectors, exact in every round, with ns-bounds.

Every vector keeps, for each centroid, its squared distance when last evaluated and the round that
was in; the driver keeps the centroids of all rounds. A stored distance is loosened by the norm of the
centroid's total displacement since that round, which is never more than the sum of its
moves and often much less. Where the loosened bounds leave a centroid in question, the exact
integer distances are computed; all decisions and sums are integers.

Vectors are written once, dealt into buckets by row number. What changes from round to
round, the bounds, is a small table in the same buckets, so that a round joins both without
a shuffle, writes the new bounds, and adds the vectors that changed cluster to running sums.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, scratch_path, ship_by_value, stage
from .common import read_table
from .vectors import usable

ship_by_value(__name__)

#: components below which squared distances of up to 512 components fit 64 bits
NARROW = 1 << 26
#: components from which a squared distance cannot be held at all
WIDEST = 1 << 59
_SLACK = 1e-12  # relative error allowed for in roots and norms


@dataclass
class Clustering:
    """``assigned`` has ``uid, vec_id, cluster, distance``; ``evaluations`` counts exact distances per pass."""

    assigned: DataFrame | None
    centroids: list[list[int]]
    evaluations: list[int] = field(default_factory=list)


def squared(x: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    apart = x - centroid
    return (apart * apart).sum(axis=1)


def displacements(history: list[np.ndarray]) -> np.ndarray:
    """Round × centroid: how far the newest centroids lie from those of each round."""
    norms = [np.sqrt(((history[-1] - h).astype(float) ** 2).sum(axis=1)) for h in history]
    return np.array(norms) * (1 + _SLACK)


def reassign(x: np.ndarray, cluster: np.ndarray, squares: np.ndarray, seen: np.ndarray, history: list[np.ndarray], moved: np.ndarray) -> int:
    """Bring assignments up to the newest centroids, in place; returns the exact distances computed.

    ``cluster`` is -1 for new vectors, of which nothing is known. A centroid is left out only if its lower bound lies
    strictly above the upper bound of the vector's own, so ties are always computed.
    """
    now, newest, k = len(history) - 1, history[-1], len(history[-1])
    rows = np.arange(len(x))
    fresh = cluster < 0
    own = np.where(fresh, 0, cluster)
    roots = np.sqrt(squares.astype(float))
    loose = moved[seen, np.arange(k)]
    lower = roots * (1 - _SLACK) - loose
    upper = roots[rows, own] * (1 + _SLACK) + loose[rows, own]
    open_ = (lower <= upper[:, None]) | fresh[:, None]
    open_[rows, own] = fresh
    asked = open_.any(axis=1)
    count = 0
    for c in range(k):  # a vector's own centroid first
        at = np.flatnonzero(asked & (own == c) & ((seen[:, c] != now) | fresh))
        squares[at, c], seen[at, c] = squared(x[at], newest[c]), now
        count += len(at)
    upper = np.sqrt(squares[rows, own].astype(float)) * (1 + _SLACK)
    open_ &= fresh[:, None] | (lower <= upper[:, None])
    open_[rows, own] = False
    for c in range(k):
        at = np.flatnonzero(open_[:, c])
        squares[at, c], seen[at, c] = squared(x[at], newest[c]), now
        count += len(at)
    open_[rows, own] = True
    best, least = own.copy(), squares[rows, own].copy()
    for c in range(k):
        better = open_[:, c] & ((squares[:, c] < least) | ((squares[:, c] == least) & (c < best)))
        best[better], least[better] = c, squares[better, c]
    cluster[:] = best
    return count


def _sum_by(x: np.ndarray, cluster: np.ndarray, k: int) -> np.ndarray:
    return np.array([x[cluster == c].sum(axis=0) if (cluster == c).any() else np.zeros(x.shape[1], x.dtype) for c in range(k)], dtype=object)


class _Pass:
    """One round over the joined vectors and bounds of a task."""

    def __init__(self, history: list[list[list[int]]], wide: bool, last: bool):
        self.history, self.wide, self.last = history, wide, last

    def number(self) -> pa.DataType:
        return pa.decimal128(38, 0) if self.wide else pa.int64()

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = object if self.wide else np.int64
        history = [np.array(h, dtype=kind) for h in self.history]
        moved, k, dim = displacements(history), len(history[-1]), len(history[-1][0])
        moves = np.zeros((k, dim), dtype=object)
        members, count, uid = np.zeros(k, np.int64), 0, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            at = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            uid = at["uid"][0].as_py() if uid is None else uid
            x = self._matrix(at["ints"], n)
            if "cluster" in at:
                cluster = at["cluster"].to_numpy().astype(np.int64)
                squares, seen = self._matrix(at["squares"], n), at["seen"].flatten().to_numpy().reshape(n, k).astype(np.int64)
            else:
                cluster, squares, seen = np.full(n, -1), np.zeros((n, k), kind), np.zeros((n, k), np.int64)
            before = cluster.copy()
            count += reassign(x, cluster, squares, seen, history, moved)
            if self.last:
                distance = np.array([0] * n, dtype=kind)
                for c in range(k):
                    rows = np.flatnonzero(cluster == c)
                    distance[rows] = squared(x[rows], history[-1][c])
                fits = [int(d) if d < 1 << 63 else None for d in distance.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [at["uid"], at["vec_id"], pa.array(cluster, pa.int32()), pa.array(fits, pa.int64())], ["uid", "vec_id", "cluster", "distance"]
                )
                continue
            changed = np.flatnonzero(cluster != before)
            left, come = before[changed], cluster[changed]
            moves += _sum_by(x[changed], come, k) - _sum_by(x[changed], left, k)
            members += np.bincount(come, minlength=k) - np.bincount(left[left >= 0], minlength=k)
            yield self._rows(at["uid"], cluster, squares, seen)
        if uid is not None and not self.last:
            yield self._totals(uid, moves, members, count)

    def _matrix(self, column: pa.Array, n: int) -> np.ndarray:
        flat = column.flatten()
        if self.wide:
            return np.array([int(v) for v in flat.to_pylist()], dtype=object).reshape(n, -1)
        return flat.to_numpy().astype(np.int64).reshape(n, -1)

    def _schema(self) -> pa.Schema:
        big = pa.decimal128(38, 0)
        return pa.schema([("uid", pa.int64()), ("cluster", pa.int32()), ("squares", pa.list_(self.number())), ("seen", pa.list_(pa.int32())),
                          ("moves", pa.list_(big)), ("members", pa.int64()), ("evaluations", pa.int64())])

    def _rows(self, uid: pa.Array, cluster: np.ndarray, squares: np.ndarray, seen: np.ndarray) -> pa.RecordBatch:
        n, k = squares.shape
        ends = pa.array(np.arange(n + 1) * k, pa.int32())
        cells = pa.ListArray.from_arrays(ends, _numbers(squares, self.number()))
        rounds = pa.ListArray.from_arrays(ends, pa.array(seen.ravel(), pa.int32()))
        schema = self._schema()
        empty = [pa.nulls(n, schema.field(c).type) for c in ("moves", "members", "evaluations")]
        return pa.RecordBatch.from_arrays([uid, pa.array(cluster, pa.int32()), cells, rounds, *empty], schema=schema)

    def _totals(self, uid: int, moves: np.ndarray, members: np.ndarray, count: int) -> pa.RecordBatch:
        """A task's changes of each cluster; they go by one of its row numbers, so to the same bucket."""
        k, schema = len(members), self._schema()
        none = [pa.nulls(k, schema.field(c).type) for c in ("squares", "seen")]
        sums = pa.ListArray.from_arrays(pa.array(np.arange(k + 1) * moves.shape[1], pa.int32()), _numbers(moves, pa.decimal128(38, 0)))
        each = pa.array([count] + [0] * (k - 1), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array([uid] * k, pa.int64()), pa.array(range(k), pa.int32()), *none, sums, pa.array(members, pa.int64()), each], schema=schema
        )


def _numbers(cells: np.ndarray, kind: pa.DataType) -> pa.Array:
    if kind == pa.int64():
        return pa.array(cells.ravel().astype(np.int64), kind)
    from decimal import Decimal

    return pa.array([Decimal(int(v)) for v in cells.ravel().tolist()], kind)


def _bucketed(df: DataFrame, buckets: int, name: str) -> tuple[DataFrame, str]:
    """The frame as a written table in buckets of ``uid``, and its folder. The catalog keeps no entry."""
    spark = df.sparkSession
    path, table = scratch_path(spark, name), f"{name}_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, "uid").option("path", path).saveAsTable(table)
    found = spark.table(table)
    found.schema  # noqa: B018 - resolved now, as the catalog forgets the table; its files stay
    spark.sql(f"DROP TABLE {table}")
    return found, path


def seeds(vectors: DataFrame, k: int, salt: str) -> list[list[int]]:
    """Up to ``k`` vectors whose ``salt:vec_id`` hash least, in order; null ids come last, ties by components."""
    mark = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = vectors.select("ints", mark.alias("mark")).orderBy(F.col("mark").asc_nulls_last(), "ints").limit(k)
    return [[int(v) for v in r.ints] for r in first.collect()]


def cluster(vectors: DataFrame, k: int, rounds: int, salt: str) -> Clustering:
    """Cluster ``(vec_id, ints)``, arrays of whole numbers of one length, in exactly ``rounds`` rounds of Lloyd's.

    Centroids start as ``seeds``. Each round assigns every vector to the nearest (ties: smaller number) and moves
    non-empty centroids to the componentwise floor of the mean; then vectors are assigned once more.
    Rounds that can't change anything any more are left out. Repeated rows and ids are vectors of their own. Of an
    empty table nothing is assigned. Distances beyond 64 bits are null.

    The driver holds rounds × k centroids. A round reads all vectors and writes k distances a vector; bounds of earlier rounds are deleted.
    """
    spark = vectors.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbered = vectors.select(F.monotonically_increasing_id().alias("uid"), F.col("vec_id").cast("bigint").alias("vec_id"), "ints")
    rows, _ = _bucketed(numbered.repartition(buckets, "uid"), buckets, "vectors")
    history = [seeds(rows, k, salt)]
    if not history[0]:
        return Clustering(None, [])
    k, dim = len(history[0]), len(history[0][0])
    largest = rows.agg(F.max(F.greatest(F.array_max("ints"), -F.array_min("ints")))).first()[0]
    wide = int(largest) >= NARROW
    if wide:
        rows = rows.withColumn("ints", F.col("ints").cast("array<decimal(38,0)>"))
    number = "decimal(38,0)" if wide else "bigint"
    kind = f"uid bigint, cluster int, squares array<{number}>, seen array<int>, moves array<decimal(38,0)>, members bigint, evaluations bigint"
    sums, members = [[0] * dim for _ in range(k)], [0] * k
    found, path, joined = Clustering(None, history[0]), None, rows
    for _ in range(rounds):
        state, new_path = _bucketed(joined.mapInArrow(_Pass(history, wide, False), kind), buckets, "bounds")
        # one row per task and cluster; k rows of dim sums reach the driver
        totals = state.where("moves IS NOT NULL")
        columns = [F.sum(F.get("moves", F.lit(i))).alias(f"move{i}") for i in range(dim)]
        counted = totals.groupBy("cluster").agg(F.sum("members").alias("members"), F.sum("evaluations").alias("evaluations"), *columns).collect()
        for r in counted:
            members[r.cluster] += r.members
            sums[r.cluster] = [s + int(r[f"move{i}"]) for i, s in enumerate(sums[r.cluster])]
        found.evaluations.append(sum(r.evaluations for r in counted))
        if path:
            discard(spark, path)
        path = new_path
        # both sides lie in the same buckets: no exchange; the bounds of a bucket are the smaller side
        known = state.where("moves IS NULL").select("uid", "cluster", "squares", "seen")
        joined = rows.join(known.hint("shuffle_hash"), "uid")
        newest = [[s // members[c] for s in sums[c]] if members[c] else history[-1][c] for c in range(k)]
        if newest == history[-1]:
            break
        history = [*history, newest]
    last = joined.mapInArrow(_Pass(history, wide, True), "uid bigint, vec_id bigint, cluster int, distance bigint")
    found.centroids, found.assigned = history[-1], stage(last)
    return found


def stepped(rows: DataFrame, id_col: str, vec_col: str, dim: int, scale: int) -> DataFrame:
    """``vec_id, ints``: floors of scaled components of the vectors with ``dim`` finite ones.

    Vectors with a component of ``WIDEST`` steps or more take no part: no distance from them could be held.
    """
    vec = F.col(vec_col)
    kept = rows.select(F.col(id_col).alias("vec_id"), vec.alias("vec")).where(usable(F.col("vec"), True) & (F.size("vec") == dim))
    held = kept.where(F.forall("vec", lambda x: F.abs(x.cast("double")) * scale < WIDEST))
    return held.select("vec_id", F.transform("vec", lambda x: F.floor(x.cast("double") * scale)).alias("ints"))


def op12_ns_bounds_centroids(spark, sf_dir):
    """Clusters of all embeddings of 64 components after ten rounds from eight seeds."""
    vectors = stepped(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 64, 1024)
    found = cluster(vectors, 8, 10, "3")
    kind = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    if found.assigned is None:
        return spark.createDataFrame([], kind)
    sums = {r.cluster: int(r.s) for r in found.assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect() if r.s is not None}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centroids]

    def held(value: int):
        return value if value < 1 << 63 else None

    per_cluster = [(c, held(s), held(sum(sums.values())), digests[c]) for c, s in sums.items()]
    notes = spark.createDataFrame(per_cluster, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    # at most one row per cluster
    return found.assigned.join(F.broadcast(notes), "cluster", "left").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _op12_sql(k: int = 8, rounds: int = 10) -> str:
    """Plain rounds over all distances."""
    apart = "list_sum(list_transform(list_zip(v.x, c.c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    steps = [
        """v AS (SELECT row_number() OVER () AS uid, vec_id, list_transform(embedding, lambda e: CAST(floor(1024 * CAST(e AS DOUBLE)) AS HUGEINT)) AS x
        FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64)""",
        f"""c0 AS (SELECT k, c FROM (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST, x) - 1 AS k, x AS c FROM v) WHERE k < {k})""",
    ]
    for r in range(rounds + 1):
        # distance and number in one: the least is the nearest, ties to the smaller number
        steps.append(f"a{r} AS MATERIALIZED (SELECT v.uid, min({apart} * {k} + c.k) AS code FROM v CROSS JOIN c{r} c GROUP BY v.uid)")
        if r < rounds:
            steps.append(
                f"""s{r} AS (SELECT k, i, sum(e) AS s, count(*) AS n FROM (
                SELECT a.code % {k} AS k, unnest(v.x) AS e, generate_subscripts(v.x, 1) AS i FROM v JOIN a{r} a USING (uid)) GROUP BY k, i)"""
            )
            steps.append(
                f"""c{r + 1} AS MATERIALIZED (SELECT c.k, coalesce(m.c, c.c) AS c FROM c{r} c LEFT JOIN (
                SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM s{r} GROUP BY k) m ON c.k = m.k)"""
            )
    return f"""
    WITH {", ".join(steps)},
    d AS (SELECT v.vec_id, CAST(a.code % {k} AS INTEGER) AS cluster, CAST(a.code // {k} AS BIGINT) AS distance FROM v JOIN a{rounds} a USING (uid))
    SELECT d.vec_id, d.cluster, d.distance, CAST(sum(d.distance) OVER (PARTITION BY d.cluster) AS BIGINT) AS cluster_inertia,
           CAST(sum(d.distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.c, ',')) AS centroid_sha256
    FROM d JOIN c{rounds} c ON d.cluster = c.k
    """


OP12_SQL = _op12_sql()
