import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from lectio.llm import source_mix as M


def water_fill(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    """Shares by weight, excess shared again until nobody is above the cap."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free, left = {}, set(order), share * sum(sizes.values())
    while free:
        total = sum(w[s] for s in free)
        over = {s for s in free if left * w[s] / total > cap * sizes[s]}
        if not over:
            target.update({s: left * w[s] / total for s in free})
            break
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
        free -= over
    return target


def n_words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def check(rows, got, n_ranges_checked=True):
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += n_words(t)
    want = water_fill(sizes)
    taken, biggest = defaultdict(int), defaultdict(int)
    assert len(got) == len(rows)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.source] += r.taken
        biggest[r.source] = max(biggest[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= biggest[s] / 2 + 1


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text, r.source) for r in odd_docs.collect()]
    check(rows, M.mix_sources(odd_docs).collect())
    assert M.mix_sources(no_docs).count() == 0
    assert {r.target for r in M.mix_sources(odd_docs.where("text is null")).collect()} == {0.0}


def test_against_water_filling_and_partitions(spark):
    rnd = random.Random(3)
    rows = [(i, "w " * rnd.randrange(40), rnd.choice(["A", "a", "é", "zz", None] + ["hot"] * 5)) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    one = M.mix_sources(df).collect()
    check(rows, one)
    many = M.mix_sources(df.repartition(13), rows_per_range=7).collect()  # ranges change nothing
    assert sorted(map(tuple, one)) == sorted(map(tuple, many))


def test_native_plan(odd_docs):
    plan = M.mix_sources(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_mixed_documents_repeat_as_planned(odd_docs, no_docs):
    plan = sum(r.epochs for r in M.mix_sources(odd_docs).collect())
    mixed = M.mixed_documents(odd_docs)
    assert mixed.schema == odd_docs.schema and mixed.count() == plan
    assert M.mixed_documents(no_docs).count() == 0


def test_words_delivered_are_words_planned_without_ids(spark):
    """3000 documents without ids and equal sizes, whose source is cut
    mid-way, and as many that repeat id and text."""
    rows = [(None, f"a{i} b c d", "cut") for i in range(3000)] + [(7, "same four words here", "cut")] * 1500
    rows += [(i, "w " * (i % 9), "other") for i in range(800)] + [(None, None, None), (None, "x y", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    plan = M.mix_sources(df, rows_per_range=100)
    check(rows, plan.collect())
    planned = {r.source: r.n for r in plan.groupBy("source").agg(F.sum("taken").alias("n")).collect()}
    words = M.n_words(F.col("text"))
    mixed = M.mixed_documents(df, rows_per_range=100)
    assert {r.source: r.n for r in mixed.groupBy("source").agg(F.sum(words).alias("n")).collect()} == planned
    cut = mixed.where("source = 'cut'").groupBy("doc_id").count().collect()
    assert all(r["count"] > 0 for r in cut) and len(cut) == 2


def test_no_range_or_key_holds_a_source_without_ids(spark):
    """Null ids spread by their texts; rows that repeat both are summed by slice."""
    df = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("t "), "id").alias("text"), F.lit("s").alias("source"))
    rows = M._rows(df.repartition(4), "doc_id", "text", "source", "x")
    ranges = rows.groupBy(F.substring("key", 1, 1)).count().collect()
    assert len(ranges) == 16 and max(r["count"] for r in ranges) < 2 * 4000 / 16
    same = M._rows(df.withColumn("text", F.lit("same")).repartition(4), "doc_id", "text", "source", "x")
    assert same.select("key").distinct().count() == 1 and same.groupBy("key", "slice").count().count() >= 2
