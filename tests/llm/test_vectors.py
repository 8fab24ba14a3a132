import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectio.llm import bisector_tournament as B
from lectio.llm import collision_search as N
from lectio.llm import inverted_multi_index as M

NAN, INF = float("nan"), float("inf")
SHAPE = "vec_id long, embedding array<float>, label int, id string, v string, cluster string, score string, block string, row string"
CLASH = ("clash",) * 6


def vectors(spark, rows, dim_type="float"):
    return spark.createDataFrame([(*r, *CLASH) for r in rows], SHAPE.replace("float", dim_type))


def random_rows(seed, n, dim, spread=0.15, labels=3):
    """Vectors around a few centres, with copies, ties and repeated ids."""
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 0.3) for _ in range(dim)] for _ in range(5)]
    rows = [(i, [c + rnd.gauss(0, spread) for c in rnd.choice(centres)], rnd.randrange(labels)) for i in range(n)]
    rows += [(i + n, rows[i * 3 % n][1], rows[i][2]) for i in range(n // 4)]
    return rows + rows[:3]


def odd(dim):
    bad = [(900, None, 1), (901, [0.1] * (dim - 1) + [None], 1), (1000, [NAN] + [0.1] * (dim - 1), 0), (1001, [INF] + [0.2] * (dim - 1), 0)]
    return bad + [(1002, [0.0] * dim, 1), (None, [0.3] * dim, 1), (None, [-0.2] * dim, None), (1100, [0.25] * dim, None)]


def lloyd(rows, k, rounds, dim, salt="2"):
    """Plain nearest-centroid search in Python's whole numbers."""
    kept = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v, _ in rows
            if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{salt}:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for c in range(len(centroids)):
            mine = [v for (_, v), o in zip(kept, own) if o == c]
            if mine:
                centroids[c] = [sum(x) // len(mine) for x in zip(*mine)]
    final = [(i, *nearest(v)) for i, v in kept]
    by = {c: sum(d for _, d, n in final if n == c) for _, _, c in final}
    return sorted(((i, c, d, by[c], sum(by.values()), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
                   for i, d, c in final), key=repr)


@pytest.mark.parametrize("seed, n, dim, k", [(1, 120, 8, 7), (2, 30, 3, 40)])
def test_clusters_equal_plain_lloyd(spark, seed, n, dim, k):
    rows = random_rows(seed, n, dim) + odd(dim) + [(2000, [0.1] * (dim + 1), 0), (2001, [], 0)]
    got = B.cluster_vectors(vectors(spark, rows).repartition(3), k=k, rounds=5, dim=dim)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == lloyd(rows, k, 5, dim)


def test_ties_go_to_the_smaller_number(spark):
    centroids = np.array([[0, 0], [2, 0], [0, 0], [0, 2]])
    assert B.winners(np.array([[1, 0], [1, 1], [0, 0], [2, 0], [0, 1], [0, 9]]), *B.bisectors(centroids)).tolist() == [0, 0, 0, 1, 0, 3]


def test_no_vectors_and_bad_parameters(spark):
    assert B.cluster_vectors(vectors(spark, [])).count() == 0
    assert B.cluster_vectors(vectors(spark, odd(64)).where("vec_id < 1002")).count() == 0
    with pytest.raises(ValueError):
        B.cluster_vectors(vectors(spark, []), k=100_000)
    with pytest.raises(Exception, match="beyond"):
        B.cluster_vectors(vectors(spark, [(1, [1e30], 0)]), dim=1).count()


def test_only_centroids_are_broadcast(spark):
    plan = B.cluster_vectors(vectors(spark, random_rows(4, 40, 4)), dim=4, k=5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == plan.count("BroadcastExchange") == 1


def exact_nearest(rows, k, asks):
    kept = [(n, i, np.array(v, np.float64)) for n, (i, v, _) in enumerate(rows)
            if v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for n, i, v in kept:
        if i is not None and asks(i):
            away = sorted((float(np.sqrt(((w - v) ** 2).sum())), j is None, j or 0) for m, j, w in kept if m != n)
            out.setdefault(i, []).append([(j if not none else None, d) for d, none, j in away[:k]])
    return out


@pytest.mark.parametrize("seed, n, dim, spread", [(1, 900, 24, 0.15), (2, 500, 64, 1.0), (3, 700, 2, 0.01)])
def test_nearest_recall(spark, seed, n, dim, spread):
    rows = [(i, [float(np.float32(x)) for x in v], lab) for i, v, lab in random_rows(seed, n, dim, spread)]
    rows += [(5000 + i, rows[0][1], 0) for i in range(40)] + odd(dim)
    got = N.nearest(vectors(spark, rows).repartition(4), F.col("vec_id") % 20 == 0, block_rows=300, chunk_rows=30).collect()
    want = exact_nearest(rows, 10, lambda i: i % 20 == 0)
    mine = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        mine.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(mine) == set(want)
    hits = total = 0
    for q, lists in want.items():
        scores = sorted(s for one in lists for _, s in one)
        assert len(mine[q]) == len(scores)
        hits += sum(s <= scores[-1] + 1e-12 for _, s in mine[q])
        total += len(scores)
        if len(lists) == 1:
            assert mine[q] == sorted(mine[q], key=lambda x: (x[1], x[0] is None, x[0] or 0))
            if [s for _, s in mine[q]] == [s for _, s in lists[0]]:  # all found: ties by id as well
                assert mine[q] == lists[0]
    assert hits / total >= 0.95


def test_nearest_few_rows(spark):
    same = [0.5, 0.5]
    assert N.nearest(vectors(spark, []), F.col("vec_id") % 100 == 0).count() == 0
    assert N.nearest(vectors(spark, [(1, same, 0)]), F.col("vec_id") % 100 == 0).count() == 0
    rows = [(100, same, 0), (7, same, 0), (3, same, 0), (None, same, 0), (5, [0.5], 0), (6, [], 0)]
    got = N.nearest(vectors(spark, rows), F.col("vec_id") % 100 == 0).collect()
    assert sorted((r["rank"], r.vec_id, r.score) for r in got) == [(1, 3, 0.0), (2, 7, 0.0), (3, None, 0.0), (4, 5, 0.5)]


def test_collision_threshold():
    assert N.collision_threshold(64, 50.0, 0.01) == 64 and N.collision_threshold(64, 0.0, 0.01) == 0
    assert 30 < N.collision_threshold(64, 1.1, 0.005) < 46


def mined(rows, asks, positives=5, negatives=10):
    """Hard negatives by comparing everything with everything."""
    kept = [(n, i, lab, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for n, (i, v, lab) in enumerate(rows)
            if lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []

    def best(q, fits, k):
        scored = [(sum(a * b for a, b in zip(q, v)), i, n) for n, i, lab, v in kept if fits(n, lab)]
        return sorted(scored, key=lambda s: (-s[0], s[1] is None, s[1] or 0))[:k] if k else scored

    for n, i, lab, q in kept:
        if i is None or not asks(i):
            continue
        others = best(q, lambda m, other: other != lab, 0)
        for score, positive, _ in best(q, lambda m, other: m != n and other == lab, positives):
            hard = sorted(((s, j) for s, j, _ in others if 30 * score <= 100 * s <= 90 * score),
                          key=lambda s: (-s[0], s[1] is None, s[1] or 0))[:negatives]
            out += [(i, positive, r, j, score, s) for r, (s, j) in enumerate(hard, 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed, n, dim, spread, few", [(1, 300, 8, 0.1, 60), (2, 200, 33, 1.0, 10_000), (3, 160, 1, 0.2, 20)])
def test_hard_negatives_equal_full_comparison(spark, seed, n, dim, spread, few):
    rows = random_rows(seed, n, dim, spread) + odd(dim) + [(3000 + i, [0.2] * dim, i % 2) for i in range(30)] + [(4000, [0.5], 1), (4001, [], 2)]
    got = M.hard_negatives(vectors(spark, rows).repartition(3), F.col("vec_id") % 20 == 0, codewords=4, block_rows=16, chunk_rows=5, first_visits=few)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect()), key=repr) == mined(rows, lambda i: i % 20 == 0)


def test_hard_negatives_of_little(spark):
    asks = F.col("vec_id") % 100 == 0
    for rows in ([], odd(4)[:4], [(100, [0.5, 0.5], 1)], [(100, [0.5], 1), (1, [0.4], 2), (2, [-0.5], 1)]):
        assert M.hard_negatives(vectors(spark, rows), asks).count() == 0
    got = M.hard_negatives(vectors(spark, [(100, [0.5], 1), (1, [0.4], 2), (2, [0.5], 1), (3, [0.1], 2)]), asks).collect()
    assert list(map(tuple, got)) == [(100, 2, 1, 1, 128 * 128, 128 * 102)]


def test_cells_come_by_falling_bound_and_hold_it():
    rnd = np.random.default_rng(5)
    x = rnd.integers(-300, 300, (400, 6))
    words = M.fit_codebook(x[:, :3], 5), M.fit_codebook(x[:, 3:], 5)
    coded = [M.nearest_word(h, w) for h, w in zip((x[:, :3], x[:, 3:]), words)]
    radii = [[int(r[own == w].max(initial=0)) for w in range(len(book))] for (own, r), book in zip(coded, words)]
    for q in x[:20]:
        (low_1, up_1), (low_2, up_2) = M.half_bounds(q[:3], words[0], radii[0]), M.half_bounds(q[3:], words[1], radii[1])
        walked = list(M.by_falling_bound(up_1, up_2))
        assert [b for b, _, _ in walked] == sorted((a + b for a in up_1 for b in up_2), reverse=True)
        assert len({(i, j) for _, i, j in walked}) == len(walked) == 25
        for row, i, j in zip(x, coded[0][0], coded[1][0]):
            assert low_1[i] + low_2[j] <= int(row @ q) <= up_1[i] + up_2[j]
