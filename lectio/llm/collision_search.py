"""Nearest neighbours by collision counting.

Every vector is projected on ``projections`` random lines, and each line's
values are a sorted array. Around a query's own value on a line stands a
window; a vector collides with the query on that line when its value lies in
the window. Windows grow with the radius (virtual rehashing: only what is new
in a window is counted), and a vector that collides on at least ``threshold``
lines is verified by its true distance. The search ends when the radius has
reached the k-th best distance found.

The threshold is the largest for which a vector at the radius itself is
missed with a probability of ``miss`` at most; nearer ones are missed more
rarely, so the expected recall is at least 1 - miss whatever the number of
vectors, and no cap on candidates is needed.

At scale: vectors are dealt by a hash of their row number into blocks of
bounded size, each with its own sorted arrays; they are built where they are
used, since sorting a block is cheaper than moving its arrays. A query first
searches the block it lies in. Its k-th distance there bounds the radius in
every other block, where queries arrive in chunks of bounded size: the work
is the stated query set against all rows in blocks, and a task holds one
block and one chunk. Copies of a vector, however many, spread over all
blocks."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectio.llm.common import written
from lectio.llm.vectors import finite, matrix

BLOCK_ROWS, CHUNK_ROWS, BLOCK_COMPONENTS = 4096, 512, 2**21


def hit_rate(half_width: float) -> float:
    """Probability that a standard normal value lies within ± half_width."""
    return math.erf(half_width / math.sqrt(2))


def collision_threshold(lines: int, half_width: float, miss: float) -> int:
    """Largest number of collisions that a vector at the radius reaches with
    a probability of at least 1 - miss."""
    p, below = hit_rate(half_width), 0.0
    for hits in range(lines + 1):
        below += math.comb(lines, hits) * p**hits * (1 - p) ** (lines - hits)
        if below > miss:
            return hits
    return lines


class Block:
    """The vectors of a block with a sorted array per line."""

    def __init__(self, x: np.ndarray, tie: np.ndarray, lines: np.ndarray, half_width: float, threshold: int, growth: float):
        self.x, self.tie, self.lines = x, tie, lines
        self.half_width, self.threshold, self.growth = half_width, threshold, growth
        values = (x @ lines).T
        self.order = np.argsort(values, axis=1, kind="stable")
        self.values = np.take_along_axis(values, self.order, axis=1)
        # products of equal vectors may differ in their last bits
        self.slack = 1e-9 * float(np.abs(values).max(initial=0))

    def _window(self, at: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
        reach = radius * self.half_width + self.slack
        first = [np.searchsorted(v, a - reach, "left") for v, a in zip(self.values, at)]
        last = [np.searchsorted(v, a + reach, "right") for v, a in zip(self.values, at)]
        return np.array(first), np.array(last)

    def search(self, q: np.ndarray, own: int, k: int, bound: float) -> tuple[np.ndarray, np.ndarray]:
        """(positions, distances) of the best ``k`` within ``bound`` that
        collide often enough; ``own`` is the query's position here or -1."""
        n = len(self.x)
        at = q @ self.lines
        count, seen = np.zeros(n, np.int32), np.zeros(n, bool)
        away = np.full(n, np.inf)
        if own >= 0:
            seen[own] = True
        widest = float(np.maximum(np.abs(self.values[:, 0] - at), np.abs(self.values[:, -1] - at)).max(initial=0))
        least = widest * 1e-6
        if np.isfinite(bound):
            radius = bound / self.growth**2
        else:  # about where a window has its first 4 k values
            near = np.sort(np.abs(self.values - at[:, None]), axis=1)[:, min(n, 4 * k) - 1]
            radius = float(np.median(near)) / self.half_width
        first = last = None
        limit, found = bound, 0
        while True:
            lo, hi = self._window(at, radius)
            fresh = []
            for i, row in enumerate(self.order):
                if first is None:
                    fresh.append(row[lo[i]:hi[i]])
                else:
                    fresh += [row[lo[i]:first[i]], row[last[i]:hi[i]]]
            first, last = lo, hi
            count += np.bincount(np.concatenate(fresh), minlength=n).astype(np.int32)
            new = np.flatnonzero((count >= self.threshold) & ~seen)
            seen[new] = True
            away[new] = np.sqrt(((self.x[new] - q) ** 2).sum(axis=1))
            found += len(new)
            if found >= k:
                limit = min(bound, float(np.partition(away, k - 1)[k - 1]))
            if radius >= limit or (hi - lo == n).all():
                break
            radius = min(max(radius * (self.growth if np.isfinite(limit) else 2), least), limit)
        best = np.flatnonzero(np.isfinite(away) & (away <= limit))
        best = best[np.lexsort((self.tie[best], away[best]))[:k]]
        return best, away[best]


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query: nearest first, then smaller id, then row."""
    by = Window.partitionBy("query").orderBy("score", F.col("id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def nearest(rows: DataFrame, queries: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 10,
            projections: int = 64, half_width: float = 1.1, miss: float = 0.005, growth: float = 1.15, seed: int = 12,
            block_rows: int = BLOCK_ROWS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """For each row of ``queries`` (a condition on ``rows``) its ``k``
    nearest other rows: query_id, rank, id, score (Euclidean distance of the
    original vectors in double precision); fewer where there are fewer rows.

    Null, empty and zero vectors and those with a null or non-finite
    component take no part, neither as queries. A vector shorter than the
    longest counts as ended by zeros. Every row stands for itself: rows that
    repeat an id or a vector are found each, a row never finds itself. Equal
    scores go to the smaller id, null ids last. An empty table, or one
    without queries, gives no rows. The expected share of true neighbours
    that are found is 1 - ``miss`` or more."""
    spark = rows.sparkSession
    base = rows.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v"), F.coalesce(queries, F.lit(False)).alias("asks"))
    base = base.where(finite(F.col("v")) & F.exists("v", lambda x: x != 0))
    base = written(base.select(F.monotonically_increasing_id().alias("row"), "id", F.col("v").cast("array<double>").alias("v"), "asks"),
                   "collision-vectors")
    n, n_queries, dim = base.agg(F.count(F.lit(1)), F.count_if("asks"), F.coalesce(F.max(F.size("v")), F.lit(1))).first()
    block_rows = max(64, min(block_rows, BLOCK_COMPONENTS // dim))
    blocks, chunks = max(1, -(-n // block_rows)), max(1, -(-n_queries // chunk_rows))

    def dealt(of: int, salt: str) -> Column:
        return F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(of)).cast("int")

    base = base.withColumn("block", dealt(blocks, "block"))
    asking = base.where("asks").withColumn("chunk", dealt(chunks, "chunk"))
    lines = np.random.default_rng(seed).standard_normal((dim, projections))
    threshold = collision_threshold(projections, half_width, miss)
    id_type = base.schema["id"].dataType.simpleString()
    found_type = f"query long, query_id {id_type}, row long, id {id_type}, score double"

    def search(vectors: pa.Table, asked: pa.Table) -> pa.Table:
        out = {"query": [], "query_id": [], "row": [], "id": [], "score": []}
        ids = vectors["id"].combine_chunks()
        if len(vectors) and len(asked):
            own_rows = vectors["row"].to_numpy()
            tie = np.empty(len(ids), np.int64)
            tie[pc.sort_indices(ids, sort_keys=[("", "ascending")], null_placement="at_end").to_numpy()] = np.arange(len(ids))
            block = Block(matrix(vectors["v"], dim, np.float64), tie, lines, half_width, threshold, growth)
            place = {r: i for i, r in enumerate(own_rows.tolist())}
            asked_v, bounds = matrix(asked["v"], dim, np.float64), asked["bound"].to_numpy()
            for q, query, query_id, bound in zip(asked_v, asked["row"].to_pylist(), asked["id"].to_pylist(), bounds):
                best, away = block.search(q, place.get(query, -1), k, float(bound))
                out["query"] += [query] * len(best)
                out["query_id"] += [query_id] * len(best)
                out["row"] += own_rows[best].tolist()
                out["id"] += ids.take(pa.array(best)).to_pylist()
                out["score"] += away.tolist()
        kinds = {"query": pa.int64(), "query_id": ids.type, "row": pa.int64(), "id": ids.type, "score": pa.float64()}
        return pa.table({c: pa.array(out[c], t) for c, t in kinds.items()})

    at_home = asking.select("block", "row", "id", "v", F.lit(float("inf")).alias("bound"))
    home = written(base.groupBy("block").cogroup(at_home.groupBy("block")).applyInArrow(search, found_type), "collision-home")
    bounds = home.groupBy(F.col("query").alias("of")).agg(
        F.when(F.count(F.lit(1)) >= k, F.max("score")).otherwise(F.lit(float("inf"))).alias("bound"))
    asked = written(asking.join(bounds, F.col("row") == F.col("of"), "left").select(
        "row", "id", "v", "chunk", F.col("block").alias("home"), F.coalesce("bound", F.lit(float("inf"))).alias("bound")),
        "collision-asked")
    abroad = asked.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")).where("block <> home").drop("home")
    everywhere = base.select("*", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk")).drop("asks")
    other = everywhere.groupBy("block", "chunk").cogroup(abroad.groupBy("block", "chunk")).applyInArrow(search, found_type)
    best = _ranked(home.unionByName(written(other, "collision-found")), k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
