"""Centroid clustering by a tournament of bisectors.

For two centroids a < b, b is nearer to x than a exactly if
2 (b - a) . x > |b|^2 - |a|^2. The normals 2 (b - a) and the thresholds are
whole numbers, computed once a round for all pairs; a vector's nearest
centroid is the winner of k - 1 such sign tests, in which zero favours the
smaller number. No distance is computed before the winner is known, then it
is exact.

At scale: a round is one scan; each task hands on a row of sums per centroid,
which Spark adds up, so k * dim numbers reach the driver however many
vectors there are. Broadcast are the k * k * dim normals (k is at most
``MOST_CENTROIDS``). Vectors never move between tasks, so copies of one
vector are rows like others."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectio.llm.common import written
from lectio.llm.vectors import finite, matrix, whole

MOST_CENTROIDS = 256


def bisectors(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(normals, thresholds) by [a, b]: b beats a where normal . x exceeds
    the threshold."""
    squares = (centroids * centroids).sum(axis=1)
    return 2 * (centroids[None, :, :] - centroids[:, None, :]), squares[None, :] - squares[:, None]


def winners(x: np.ndarray, normals: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """Number of each row's nearest centroid, the smaller one of equal ones.
    The best so far always has the smaller number, so only a positive side
    takes its place."""
    best = np.zeros(len(x), np.int64)
    for rival in range(1, len(normals)):
        side = np.einsum("ij,ij->i", x, normals[best, rival]) - thresholds[best, rival]
        best[side > 0] = rival
    return best


def _first_centroids(kept: DataFrame, k: int, salt: str) -> np.ndarray:
    """The k vectors with the smallest hashes of their ids, in that order;
    equal hashes (repeated ids) by the vector, null ids last."""
    tag = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")), 256)
    rows = kept.select(tag.alias("tag"), "v").orderBy(F.col("tag").asc_nulls_last(), "v").limit(k).collect()
    return np.array([r.v for r in rows], np.int64).reshape(len(rows), len(rows[0].v) if rows else 0)


def _moved(kept: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: the floor of each cluster's mean; an
    empty cluster's stays."""
    k, dim = centroids.shape
    tables = kept.sparkSession.sparkContext.broadcast(bisectors(centroids))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            x = matrix(batch.column(0), dim)
            won = winners(x, *tables.value)
            order = np.argsort(won, kind="stable")
            first = np.searchsorted(won[order], np.arange(k + 1))
            for c in np.flatnonzero(np.diff(first)):
                total[c] += x[order[first[c]:first[c + 1]]].sum(axis=0)
                n[c] += first[c + 1] - first[c]
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(n[some]), pa.array(list(total[some]), pa.list_(pa.int64()))], ["c", "n", "s"])

    parts = kept.select("v").mapInArrow(sums, "c int, n long, s array<long>").select("c", "n", F.posexplode("s").alias("at", "s"))
    out = [list(map(int, row)) for row in centroids]
    for r in parts.groupBy("c", "at").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect():
        out[r.c][r.at] = r.s // r.n
    tables.destroy()
    return np.array(out, np.int64)


def cluster_vectors(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 40, rounds: int = 5,
                    dim: int = 64, scale: int = 256, salt: str = "2") -> DataFrame:
    """One row per vector of exactly ``dim`` finite components: id,
    ``cluster``, ``distance`` (squared, of the whole components), the
    ``cluster_inertia`` and ``inertia`` and the cluster's ``centroid_sha256``.

    Rows without such a vector are left out. Repeated rows and copies of a
    vector each count; equal distances go to the smaller centroid number.
    With fewer than ``k`` vectors there are as many centroids as vectors.
    Rows with a null id take part; they are the last to become centroids.
    An empty table gives no rows."""
    if not 0 < k <= MOST_CENTROIDS:
        raise ValueError(f"k is from 1 to {MOST_CENTROIDS}: a table of all pairs goes to every executor")
    spark = rows.sparkSession
    vec = F.col(vec_col)
    kept = written(rows.select(F.col(id_col).alias("id"), vec.alias("v")).where(finite(F.col("v")) & (F.size("v") == dim))
                   .select("id", whole(F.col("v"), scale).alias("v")), "tournament-vectors")
    centroids = _first_centroids(kept, k, salt)
    id_type = kept.schema["id"].dataType.simpleString()
    shape = f"id {id_type}, cluster int, distance long"
    if not len(centroids):
        assigned = spark.createDataFrame([], shape)
    else:
        for _ in range(rounds):
            centroids = _moved(kept, centroids)
        tables = spark.sparkContext.broadcast((centroids, *bisectors(centroids)))

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            final, normals, thresholds = tables.value
            for batch in batches:
                x = matrix(batch.column("v"), dim)
                won = winners(x, normals, thresholds)
                away = x - final[won]
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(won, pa.int32()), pa.array((away * away).sum(axis=1))],
                                                 ["id", "cluster", "distance"])

        assigned = written(kept.mapInArrow(assign, shape), "tournament-assigned")
    # one row per centroid
    inertia = {r.cluster: r.s for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    stats = spark.createDataFrame(
        [(c, s, sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
         for c, s in sorted(inertia.items())],
        "of int, cluster_inertia long, inertia long, centroid_sha256 string")
    return (assigned.join(F.broadcast(stats), F.col("cluster") == F.col("of"))
            .select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))
