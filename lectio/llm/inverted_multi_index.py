"""Hard negatives from an inverted multi-index.

A vector is cut into two halves. Each half has a codebook, fitted to a
bounded sample; the pair of nearest codewords is a vector's cell. For an
anchor q and a codeword c with radius R (the largest distance of its halves
from it) no product of halves exceeds q.c + |q| R, so the sum of two such
bounds bounds every score in a cell. A heap walks the cells by falling bound
without forming all pairs (multi-sequence order). All numbers are whole, so
bounds are exact.

A search has windows of scores: [lo, hi] and how many rows are wanted from
its top. A window is certified, and closed, when the next cell's bound is
below its bottom or below the last wanted row; cells that lie above every
open window are passed over. Until then the anchor goes on, in rounds that
visit more rows each, to the last cell if need be: results are exact and no
candidate is dropped.

At scale: cells are dealt into blocks of bounded size by a hash of the row,
so a cell with a third of all rows is many blocks, and anchors visit a block
in chunks of bounded size; a task holds one block and one chunk and hands on
at most the wanted rows per window. What is broadcast is the codebooks,
radii and cell sizes, bounded by ``MOST_CODEWORDS`` squared."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectio.llm.common import written
from lectio.llm.vectors import finite, matrix, whole

#: Rows that the codebooks are fitted to (those with the smallest hashes).
SAMPLE_ROWS = 8192
MOST_CODEWORDS, BLOCK_ROWS, CHUNK_ROWS = 64, 4096, 512
#: Rows an anchor visits in the first round at least; each round has more.
FIRST_VISITS, MORE = 16_384, 8
LOWEST, HIGHEST = -(2**62), 2**62


def fit_codebook(halves: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    """At most k whole-number codewords for the rows of ``halves``."""
    if not len(halves):
        return halves
    words = np.unique(halves, axis=0)
    words = words[np.random.default_rng(11).permutation(len(words))[:k]]
    for _ in range(rounds):
        own = nearest_word(halves, words)[0]
        for w in range(len(words)):
            if (mine := own == w).any():
                words[w] = np.rint(halves[mine].mean(axis=0))
    return words


def nearest_word(halves: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of each row's codeword. Which one is
    chosen decides nothing but speed; the distance is exact."""
    near = (words.astype(float) ** 2).sum(axis=1) - 2 * (halves.astype(float) @ words.T.astype(float))
    own = near.argmin(axis=1)
    away = halves - words[own]
    return own, (away * away).sum(axis=1)


def half_bounds(q: np.ndarray, words: np.ndarray, radii: list[int]) -> tuple[list[int], list[int]]:
    """Per codeword: the least and the largest product that a half within
    its radius (given squared) can have with ``q``."""
    square = int((q * q).sum())
    middle = [int(x) for x in words @ q]
    reach = [math.isqrt(square * r) for r in radii]
    return [m - r for m, r in zip(middle, reach)], [m + r for m, r in zip(middle, reach)]


def by_falling_bound(upper_1: list[int], upper_2: list[int]) -> Iterator[tuple[int, int, int]]:
    """(bound, word 1, word 2) of all cells in the order of falling sums, by
    a heap that holds one cell per word of the first half at most."""
    first = sorted(range(len(upper_1)), key=lambda i: -upper_1[i])
    second = sorted(range(len(upper_2)), key=lambda j: -upper_2[j])
    heap = [(-(upper_1[first[0]] + upper_2[second[0]]), 0, 0)] if first and second else []
    while heap:
        bound, a, b = heapq.heappop(heap)
        yield -bound, first[a], second[b]
        if b + 1 < len(second):
            heapq.heappush(heap, (-(upper_1[first[a]] + upper_2[second[b + 1]]), a, b + 1))
        if b == 0 and a + 1 < len(first):
            heapq.heappush(heap, (-(upper_1[first[a + 1]] + upper_2[second[0]]), a + 1, 0))


class MultiIndex:
    """The written index of a table: rows (row, id, label, v, block), and
    the bounded tables that plan the visits."""

    def __init__(self, rows: DataFrame, id_col: str, vec_col: str, label_col: str, scale: int, block_rows: int,
                 codewords: int | None):
        spark = rows.sparkSession
        base = rows.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).alias("v"))
        base = base.where(F.col("label").isNotNull() & finite(F.col("v")))
        base = written(base.select(F.monotonically_increasing_id().alias("row"), "id", "label", whole(F.col("v"), scale).alias("v")),
                       "multi-vectors")
        self.id_type, self.label_type = (base.schema[c].dataType.simpleString() for c in ("id", "label"))
        n, self.dim = base.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
        self.half, dim, half = self.dim // 2, self.dim, self.dim // 2
        sample = base.orderBy(F.xxhash64("row"), "row").select("v").limit(SAMPLE_ROWS).toArrow()["v"]
        drawn = matrix(sample, dim)
        k = codewords or min(MOST_CODEWORDS, max(2, round(n**0.25)))
        words = (fit_codebook(drawn[:, :half], k), fit_codebook(drawn[:, half:], k))
        books = spark.sparkContext.broadcast(words)

        def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            one, two = books.value
            for batch in batches:
                x = matrix(batch.column("v"), dim)
                (w1, r1), (w2, r2) = nearest_word(x[:, :half], one), nearest_word(x[:, half:], two)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, *(pa.array(c, t) for c, t in ((w1, pa.int32()), (r1, pa.int64()), (w2, pa.int32()), (r2, pa.int64())))],
                    [*batch.schema.names, "w1", "r1", "w2", "r2"])

        shape = f"row long, id {self.id_type}, label {self.label_type}, v array<long>, w1 int, r1 long, w2 int, r2 long"
        cells = written(base.mapInArrow(coded, shape), "multi-cells")
        sizes = cells.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n"), F.max("r1").alias("r1"), F.max("r2").alias("r2")).collect()
        radii = ([0] * len(words[0]), [0] * len(words[1]))
        # cell: rows, first block, blocks. Small neighbours share a block, a large cell has several of its own
        self.blocks: dict[tuple[int, int], tuple[int, int, int]] = {}
        at, filled = 0, 0
        for s in sorted(sizes, key=lambda s: (s.w1, s.w2)):
            radii[0][s.w1], radii[1][s.w2] = max(radii[0][s.w1], s.r1), max(radii[1][s.w2], s.r2)
            if filled and filled + s.n > block_rows:
                at, filled = at + 1, 0
            self.blocks[s.w1, s.w2] = (s.n, at, -(-s.n // block_rows))
            filled += s.n
            if filled > block_rows:
                at, filled = at + -(-s.n // block_rows), 0
        self.words, self.radii = words, radii
        table = spark.createDataFrame([(*cell, first, many) for cell, (_, first, many) in self.blocks.items()],
                                      "c1 int, c2 int, first int, many int")
        self.rows = (cells.join(F.broadcast(table), (F.col("w1") == F.col("c1")) & (F.col("w2") == F.col("c2")))
                     .select("row", "id", "label", "v", (F.col("first") + F.pmod(F.xxhash64("row"), F.col("many"))).cast("int").alias("block")))

    def visits(self, q: np.ndarray, skip: int, budget: int, lo: int, hi: int) -> tuple[list[int], int, int]:
        """The blocks of the next cells for scores from ``lo`` to ``hi``
        after ``skip`` cells, until ``budget`` rows; cells walked so far; the
        bound on all others (``LOWEST`` when there are none)."""
        (low_1, up_1), (low_2, up_2) = (half_bounds(part, w, r) for part, w, r in
                                        zip((q[:self.half], q[self.half:]), self.words, self.radii))
        before, out, rows, n = set(), {}, 0, 0
        for bound, i, j in by_falling_bound(up_1, up_2):
            if bound < lo:
                return list(out), n, LOWEST
            if rows >= budget:
                return list(out), n, bound
            n += 1
            if (i, j) in self.blocks and low_1[i] + low_2[j] <= hi:
                size, first, many = self.blocks[i, j]
                if n <= skip:
                    before.update(range(first, first + many))
                elif first not in before:  # cells share blocks: one is read once
                    out.update(dict.fromkeys(range(first, first + many)))
                    rows += size
        return list(out), n, LOWEST


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each window: higher score, then smaller id, then row."""
    by = Window.partitionBy("anchor", "window").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def best_in_windows(index: MultiIndex, anchors: DataFrame, k: int, same_label: bool, chunk_rows: int = CHUNK_ROWS,
                    first_visits: int = FIRST_VISITS) -> DataFrame:
    """(anchor, window, row, id, score, rank): for every window of every
    anchor the ``k`` best other rows with the same label, or with another
    one, whose score lies in the window.

    ``anchors``: row (an index row's number), label, v, windows
    array<struct<window long, lo long, hi long>>."""
    spark, dim = anchors.sparkSession, index.dim
    window_type = "array<struct<window:bigint,lo:bigint,hi:bigint>>"
    plan = spark.sparkContext.broadcast((index.blocks, index.words, index.radii, index.half))
    found_type = f"anchor long, window long, row long, id {index.id_type}, score long"
    visit_type = f"row long, label {index.label_type}, v array<long>, windows {window_type}, top long, skip long, bound long, blocks array<int>"

    def walk(budget: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = MultiIndex.__new__(MultiIndex)
            own.blocks, own.words, own.radii, own.half = plan.value
            for batch in batches:
                got = [own.visits(q, skip, budget, min(w["lo"] for w in windows), top)
                       for q, skip, top, windows in zip(matrix(batch.column("v"), dim), batch.column("skip").to_pylist(),
                                                        batch.column("top").to_pylist(), batch.column("windows").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ("row", "label", "v", "windows", "top")), pa.array([g[1] for g in got], pa.int64()),
                     pa.array([g[2] for g in got], pa.int64()), pa.array([g[0] for g in got], pa.list_(pa.int32()))],
                    ["row", "label", "v", "windows", "top", "skip", "bound", "blocks"])
        return run

    def score(block: pa.Table, asked: pa.Table) -> pa.Table:
        out = {"anchor": [], "window": [], "row": [], "id": [], "score": []}
        ids = block["id"].combine_chunks()
        if len(block) and len(asked):
            rows = block["row"].to_numpy()
            tie = np.empty(len(ids), np.int64)
            tie[pc.sort_indices(ids, sort_keys=[("", "ascending")], null_placement="at_end").to_numpy()] = np.arange(len(ids))
            x, a = matrix(block["v"], dim), matrix(asked["v"], dim)
            # doubles hold every partial sum exactly below 2^53
            exact = int(np.abs(x).max(initial=0)) * int(np.abs(a).max(initial=0)) * dim < 2**53
            scores = (a.astype(float) @ x.T.astype(float)).astype(np.int64) if exact else a @ x.T
            labels = pa.concat_arrays([block["label"].combine_chunks(), asked["label"].combine_chunks()]).dictionary_encode().indices.to_numpy()
            labels, own_labels = labels[:len(ids)], labels[len(ids):]
            for s, own, anchor, windows in zip(scores, own_labels, asked["row"].to_pylist(), asked["windows"].to_pylist()):
                fits = np.flatnonzero((labels == own if same_label else labels != own) & (rows != anchor))
                for w in windows:
                    inside = fits[(s[fits] >= w["lo"]) & (s[fits] <= w["hi"])]
                    if len(inside) > k:
                        inside = inside[s[inside] >= np.partition(s[inside], len(inside) - k)[len(inside) - k]]
                    inside = inside[np.lexsort((tie[inside], -s[inside]))[:k]]
                    out["anchor"] += [anchor] * len(inside)
                    out["window"] += [w["window"]] * len(inside)
                    out["row"] += rows[inside].tolist()
                    out["id"] += ids.take(pa.array(inside)).to_pylist()
                    out["score"] += s[inside].tolist()
        kinds = {"anchor": pa.int64(), "window": pa.int64(), "row": pa.int64(), "id": ids.type, "score": pa.int64()}
        return pa.table({c: pa.array(out[c], t) for c, t in kinds.items()})

    # ``top`` stays as windows close, so what was passed over once always is
    top = F.array_max(F.transform("windows", lambda w: w["hi"])).alias("top")
    state = written(anchors.select("row", "label", "v", "windows", top, F.lit(0).cast("long").alias("skip")), "multi-open")
    n_chunks = max(1, -(-state.count() // chunk_rows))
    chunk = F.pmod(F.xxhash64("row", F.lit("chunk")), F.lit(n_chunks)).cast("int").alias("chunk")
    everywhere = index.rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))).alias("chunk"))
    found, budget = spark.createDataFrame([], found_type), first_visits
    while not state.isEmpty():
        visits = written(state.mapInArrow(walk(budget), visit_type), "multi-visits")
        asked = visits.select("row", "label", "v", "windows", chunk, F.explode("blocks").alias("block"))
        # of the index only what is visited moves
        wanted = everywhere.join(asked.select("block", "chunk").distinct(), ["block", "chunk"], "left_semi")
        new = wanted.groupBy("block", "chunk").cogroup(asked.groupBy("block", "chunk")).applyInArrow(score, found_type)
        found = written(_ranked(found.unionByName(new), k).drop("rank"), "multi-found")
        # a window is open while a row that was not seen could still belong to its best
        last = found.groupBy(F.col("anchor").alias("of"), F.col("window").alias("in")).agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
        windows = visits.where(F.col("bound") > LOWEST).select("row", "label", "v", "skip", "bound", F.explode("windows").alias("w"))
        still = windows.join(last, (F.col("row") == F.col("of")) & (F.col("w.window") == F.col("in")), "left").where(
            (F.col("bound") >= F.col("w.lo")) & (F.col("n").isNull() | (F.col("n") < k) | (F.col("bound") >= F.col("least"))))
        left = still.groupBy("row").agg(F.collect_list("w").alias("left"))
        state = written(visits.drop("windows", "blocks", "bound").join(left.withColumnRenamed("row", "of"), F.col("row") == F.col("of"))
                        .select("row", "label", "v", F.col("left").alias("windows"), "top", "skip"), "multi-open")
        budget *= MORE
    return _ranked(found, k)


def hard_negatives(rows: DataFrame, anchors: Column, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                   positives: int = 5, negatives: int = 10, low_pct: int = 30, high_pct: int = 90, scale: int = 256,
                   codewords: int | None = None, block_rows: int = BLOCK_ROWS, chunk_rows: int = CHUNK_ROWS,
                   first_visits: int = FIRST_VISITS) -> DataFrame:
    """For each row of ``anchors`` (a condition on id_col) and each of its
    ``positives`` best other rows of the same label, the ``negatives`` best
    rows of another label whose score is from ``low_pct`` to ``high_pct`` per
    cent of the positive's: anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score.

    A score is the inner product of floor(scale * x); higher comes first,
    then the smaller id, null ids last. Rows with a null label or vector or a
    null or non-finite component take no part. A vector shorter than the
    longest counts as ended by zeros. Repeated rows each stand for
    themselves; a row is never its own positive. A positive whose score is
    negative has no negatives (its window is empty). An empty table, or one
    without anchors, gives no rows."""
    index = MultiIndex(rows, id_col, vec_col, label_col, scale, block_rows, codewords)
    every = F.array(F.struct(F.lit(0).cast("long").alias("window"), F.lit(LOWEST + 1).alias("lo"), F.lit(HIGHEST).alias("hi")))
    asking = index.rows.withColumnRenamed("id", id_col).where(F.coalesce(anchors, F.lit(False))).withColumnRenamed(id_col, "id")
    found = best_in_windows(index, asking.select("row", "label", "v", every.alias("windows")), positives, True, chunk_rows, first_visits)
    pairs = written(found.select("anchor", F.col("row").alias("positive"), F.col("id").alias("positive_id"),
                                 F.col("score").alias("positive_score")), "multi-positives")
    score = F.col("positive_score")
    low, high = low_pct * score, high_pct * score
    window = F.struct(F.col("positive").alias("window"), F.call_function("div", low + F.pmod(-low, F.lit(100)), F.lit(100)).alias("lo"),
                      F.call_function("div", high - F.pmod(high, F.lit(100)), F.lit(100)).alias("hi"))
    windows = (pairs.select(F.col("anchor").alias("of"), window.alias("w")).where("w.lo <= w.hi")
               .groupBy("of").agg(F.collect_list("w").alias("windows")))
    looking = asking.join(windows, F.col("row") == F.col("of")).select("row", "label", "v", "windows")
    hard = best_in_windows(index, looking, negatives, False, chunk_rows, first_visits)
    names = asking.select(F.col("row").alias("asked"), F.col("id").alias("anchor_id"))
    pairs = pairs.join(names, F.col("anchor") == F.col("asked")).withColumnRenamed("anchor", "of")
    return (hard.join(pairs, (F.col("anchor") == F.col("of")) & (F.col("window") == F.col("positive")))
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))
