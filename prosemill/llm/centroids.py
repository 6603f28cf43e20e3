"""Centroid clustering of integer vectors with a LAESA pivot table.

The distances of every vector to a few fixed pivots are computed once and stored beside it.  In a
round, a vector x and a centroid c are at least max over pivots p of |d(x, p) - d(c, p)| apart; the
centroid with the least such bound gets its exact integer distance first, and only centroids whose
bound does not exceed it get theirs.  Bounds are floating point with a slack, so no centroid that
could win or tie is lost, and every distance that decides is an integer.

A round is one scan: each task keeps the vectors' sums by cluster, at most k rows, which Spark adds up
by (cluster, dimension); k x dimensions numbers come to the driver, which makes the new centroids.
Nothing is shuffled by cluster, so a cluster with a third of all rows is no hot group.  The rounds end
early when no centroid moves, since no later round would move one.

Defined results: vectors that are null, of another size, hold null or non-finite components, or
components whose integer is 2^27 or more in size (their squared distances pass 64 bits) take no part.
Rows with a null id are clustered, but are never initial centroids.  Repeated rows are rows each: as
initial centroids too, in the order of the hash and then of the vector.  Fewer rows than k give as many
centroids.  No rows give no rows.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosemill.llm.common import int_matrix, stored

LIMIT = 1 << 27
PIVOTS = 8
SAMPLE = 1024  # vectors, about, that pivots are chosen from
CHUNK = 2048  # vectors compared at once


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int, size: int) -> DataFrame:
    """(vec_id, v): floor(scale * x) of the vectors that take part."""
    x = F.col(vec_col)
    terms = F.transform(x, lambda v: F.floor(F.lit(float(scale)) * v.cast("double")))
    fits = F.size(x) == size
    bad = F.exists(
        x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) * scale >= float(LIMIT - 1))
    )
    return df.where(x.isNotNull() & fits).where(~bad).select(
        F.col(id_col).alias("vec_id"), F.transform(terms, lambda t: t.cast("int")).alias("v")
    )


def initial(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest SHA-256 of `seed:vec_id`, in that order."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.where("vec_id is not null").select(key.alias("key"), "v").orderBy("key", "v").limit(k)
    return int_matrix(first.orderBy("key", "v").toArrow().column("v"))


def pivots_of(vectors: DataFrame, n: int, count: int = PIVOTS) -> np.ndarray:
    """Vectors far from each other: each next one has the largest sum of distances to those before.

    Taken from a sample; the choice changes how many centroids are ruled out, not the result.
    """
    share = max(1, n // SAMPLE)
    some = vectors.where(F.pmod(F.xxhash64("v"), F.lit(share)) == 0).select("v").distinct().orderBy("v").limit(4 * SAMPLE)
    pool = int_matrix(some.toArrow().column("v"))
    if not len(pool):
        return pool
    chosen, total = [0], np.zeros(len(pool))
    while len(chosen) < min(count, len(pool)):
        total += np.sqrt(squared(pool, pool[chosen[-1]]).astype(np.float64))
        total[chosen] = -1.0
        chosen.append(int(np.argmax(total)))
    return pool[chosen]


def squared(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows to a point (or to a point each)."""
    gap = rows - point
    return np.einsum("ij,ij->i", gap, gap)


def _to_pivots(pivots: np.ndarray):
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = int_matrix(batch.column("v"), pivots.shape[1])
            table = np.sqrt(np.stack([squared(rows, p) for p in pivots], axis=1).astype(np.float64))
            flat = pa.array(table.reshape(-1))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, len(pivots), dtype=np.int32)), flat)
            yield batch.append_column("d", lists)

    return measure


def nearest(rows: np.ndarray, table: np.ndarray, centroids: np.ndarray, to_pivots: np.ndarray):
    """(cluster, squared distance, exact distances computed) of integer rows.

    table: the rows' distances to the pivots; to_pivots: the centroids'.  Ties go to the smaller number.
    """
    cluster, best = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    exact = 0
    for lo in range(0, len(rows), CHUNK):
        x, far = rows[lo : lo + CHUNK], table[lo : lo + CHUNK]
        bound = np.abs(far[:, None, :] - to_pivots[None, :, :]).max(axis=2)
        first = bound.argmin(axis=1)
        near = squared(x, centroids[first])
        # rounding: distances are right to a few parts in 2^52
        slack = 1e-9 * (1.0 + far.max(axis=1, initial=0.0) + to_pivots.max(initial=0.0))
        alive = bound - slack[:, None] <= np.sqrt(near.astype(np.float64))[:, None]
        alive[np.arange(len(x)), first] = False
        who = first.astype(np.int64)
        exact += len(x) + int(alive.sum())
        for c in range(len(centroids)):
            at = np.flatnonzero(alive[:, c])
            d = squared(x[at], centroids[c])
            better = (d < near[at]) | ((d == near[at]) & (c < who[at]))
            near[at[better]], who[at[better]] = d[better], c
        cluster[lo : lo + CHUNK], best[lo : lo + CHUNK] = who, near
    return cluster, best, exact


def _read(batch: pa.RecordBatch, centroids: np.ndarray, pivots: int):
    rows = int_matrix(batch.column("v"), centroids.shape[1])
    table = batch.column("d").flatten().to_numpy(zero_copy_only=False).reshape(len(rows), pivots)
    return rows, table


def _sums(centroids: np.ndarray, to_pivots: np.ndarray):
    """For mapInArrow: (cluster, n, sums, exact) of a task's vectors."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, size = centroids.shape
        n, sums, exact = np.zeros(k, np.int64), np.zeros((k, size), np.int64), 0
        for batch in batches:
            rows, table = _read(batch, centroids, to_pivots.shape[1])
            cluster, _, done = nearest(rows, table, centroids, to_pivots)
            exact += done
            order = np.argsort(cluster, kind="stable")
            own, first = np.unique(cluster[order], return_index=True)
            if len(own):
                sums[own] += np.add.reduceat(rows[order], first, axis=0)
                n += np.bincount(cluster, minlength=k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(k)), pa.array(n), pa.array(list(sums), pa.list_(pa.int64())),
             pa.array([exact] + [0] * (k - 1), pa.int64())],
            ["cluster", "n", "sums", "exact"],
        )

    return count


def _assigned(centroids: np.ndarray, to_pivots: np.ndarray):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, table = _read(batch, centroids, to_pivots.shape[1])
            cluster, distance, _ = nearest(rows, table, centroids, to_pivots)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance)],
                ["vec_id", "cluster", "distance"],
            )

    return assign


def _between(centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.stack([squared(centroids, p) for p in pivots], axis=1).astype(np.float64))


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, seed: int = 3, pivots: int = PIVOTS, trace: list | None = None) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every row of `vectors`.

    vectors: (vec_id, v) with v of one size.  `trace` receives (vectors, exact distances) of each round.
    """
    spark = vectors.sparkSession
    kind = vectors.schema["vec_id"].dataType.simpleString()
    plain = stored(vectors, "laesa-vectors")
    n = plain.count()
    centroids = initial(plain, k, seed) if n else np.zeros((0, 0), np.int64)
    if not len(centroids):
        return spark.createDataFrame(
            [], f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        )
    fixed = pivots_of(plain, n, pivots)
    if not len(fixed):
        fixed = centroids
    rows = stored(plain.mapInArrow(_to_pivots(fixed), f"vec_id {kind}, v array<int>, d array<double>"), "laesa-table")
    for _ in range(rounds):
        part = rows.select("v", "d").mapInArrow(
            _sums(centroids, _between(centroids, fixed)), "cluster long, n long, sums array<long>, exact long"
        )
        wide = F.sum(F.col("s").cast("decimal(38,0)"))
        got = (
            part.select("cluster", "n", "exact", F.posexplode("sums").alias("at", "s"))
            .groupBy("cluster", "at").agg(F.sum("n").alias("n"), wide.alias("s"), F.sum("exact").alias("exact"))
            .collect()  # k x dimensions numbers
        )
        new = centroids.copy()
        for r in got:
            if r.n:
                new[r.cluster, r["at"]] = int(r.s) // r.n
        if trace is not None:
            trace.append((n, sum(r.exact for r in got if r["at"] == 0)))
        if (new == centroids).all():
            break
        centroids = new
    placed = stored(
        rows.select("vec_id", "v", "d").mapInArrow(
            _assigned(centroids, _between(centroids, fixed)), f"vec_id {kind}, cluster int, distance long"
        ),
        "laesa-clusters",
    )
    total = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()
    whole = sum(int(r.d) for r in total)
    per = spark.createDataFrame(
        [(r.cluster, _long(int(r.d)), _long(whole), hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest())
         for r in total],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return placed.join(F.broadcast(per), "cluster").select(  # k rows at most
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _long(x: int) -> int | None:
    """A sum beyond 64 bits is null."""
    return x if x < 2**63 else None
