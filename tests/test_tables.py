"""Replaced tables, catalog batches, run metrics, snapshots, positions and exact sums."""

import datetime as dt
import random
import uuid
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from lectio.operators import intervals as T
from lectio.operators.batches import latest_written
from lectio.operators.metrics import numbered
from lectio.operators.quality import read_metrics, record_metrics
from lectio.plans import derive as D
from lectio.sources import catalog as C
from lectio.sources.sinks import overwrite_table

from .conftest import SF001


@pytest.fixture()
def db(spark, tmpdir_path):
    name = f"t_{uuid.uuid4().hex}"
    C.ensure_schema(spark, name, location=f"{tmpdir_path}/db")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def failing(spark):
    return spark.range(10).select(F.when(F.col("id") < 9, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).alias("id"))


@pytest.mark.parametrize("by_name", [True, False])
def test_a_failed_replacement_leaves_the_table(spark, db, tmpdir_path, by_name):
    target = f"{db}.silver" if by_name else f"{tmpdir_path}/silver"
    read = lambda: sorted(r[0] for r in (spark.table(target) if by_name else spark.read.parquet(target)).collect())
    overwrite_table(spark.range(3), target)
    with pytest.raises(Exception, match="lost"):
        overwrite_table(failing(spark), target)
    assert read() == [0, 1, 2]
    overwrite_table(spark.range(5, 7), target, sort_within=("id",))
    assert read() == [5, 6]
    overwrite_table(spark.createDataFrame([("x", 1)], "name string, n int"), target)  # other columns
    assert read() == ["x"]


def test_a_query_that_has_begun_ends_on_its_version(spark, db):
    name = f"{db}.gold"
    overwrite_table(spark.range(4), name)
    begun = spark.table(name)
    begun._jdf.queryExecution().executedPlan()  # planned on the first folder
    overwrite_table(spark.range(9), name)
    assert begun.count() in (4, 9) and spark.table(name).count() == 9
    assert C.drop_versions(spark, name) == 1 and spark.table(name).count() == 9


def test_batches_are_visible_when_added(spark, db):
    name = f"{db}.bronze"
    with pytest.raises(ValueError):
        C.latest_of(spark, name)
    assert C.latest_of(spark, name, spark.range(1).schema).count() == 0
    C.append_batch(spark.range(3), name, "20240101")
    # half-written: rows in a folder of the table that no partition names
    spark.range(50).write.parquet(C.table_folder(spark, name, "_batch=20240109-broken"))
    with pytest.raises(Exception, match="lost"):
        C.append_batch(failing(spark), name, "20240102")
    assert C.batches(spark, name) == ["20240101"] and spark.table(name).count() == 3
    C.append_batch(spark.range(5).withColumn("note", F.lit("n")), name, "20240102")
    assert C.batches(spark, name) == ["20240101", "20240102"]
    assert spark.table(name).count() == 8 and spark.table(name).where("note is null").count() == 3
    C.append_batch(spark.range(6).withColumn("note", F.lit("again")), name, "20240102")  # a retry
    assert spark.table(name).count() == 9
    newest = C.latest_of(spark, name)
    assert newest.columns == ["id", "note"] and newest.count() == 6
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_batch" in plan


def test_metrics_are_a_table(spark, tmpdir_path):
    path = f"{tmpdir_path}/metrics"
    record_metrics(spark, path, "r1", "books", {"bronze_rss": 7, "silver_books": 5})
    record_metrics(spark, path, "r1", "books", {"silver_books": 6})
    record_metrics(spark, path, "r2", "books", {"silver_books": 9})
    got = {(r.run, r.table): r.rows for r in read_metrics(spark, path).collect()}
    assert got == {("r1", "bronze_rss"): 7, ("r1", "silver_books"): 6, ("r2", "silver_books"): 9}


@pytest.mark.parametrize("frame", [D.feed_rows, D.review_pages])
def test_a_derived_snapshot_is_derived_once(spark, frame):
    rows = frame(spark, SF001)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2  # orders and customer, once each
    snap = latest_written(rows)
    plan = snap._jdf.queryExecution().executedPlan().toString()
    assert "orders.parquet" not in plan and "customer.parquet" not in plan
    newest = rows.agg(F.max("_ingested_at")).first()[0]
    assert snap.count() == rows.where(F.col("_ingested_at") == newest).count() and snap.columns == rows.columns
    assert latest_written(rows.limit(0)).count() == 0


def test_positions_follow_the_global_order(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice(["a", "b", "hot", "hot", "hot", None]), i, rnd.random()) for i in range(3000)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "user string, day int, v double").repartition(7)
    got = sorted(map(tuple, numbered(df, "user", "day").collect()), key=lambda r: r[3])
    assert [r[3] for r in got] == list(range(1, 3001))
    assert [r[:3] for r in got] == sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert numbered(df.limit(0), "user", "day").count() == 0
    plan = numbered(df, "user", "day")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") == 1  # the counts of the ranges


def books(spark):
    rnd = random.Random(8)
    rows = []
    for i in range(400):
        start = dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randrange(60))
        rows.append((f"u{rnd.randrange(3)}", f"t{i}", start, start + dt.timedelta(days=rnd.choice([0, 1, 2, 6, 13])), rnd.randrange(1, 900)))
    return rows, spark.createDataFrame(rows, "username string, title string, started_reading date, read_at date, num_pages int")


def test_sums_do_not_depend_on_partitions(spark):
    _, df = books(spark)
    before, seen = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in ("1", "5", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            for scale in (None, 1):
                days = T.pages_per_day(df.repartition(int(n)), scale=scale).select("username", "date", "est_pages_read")
                seen.append((scale, sorted(map(tuple, days.collect()))))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for scale in (None, 1):
        runs = [rows for s, rows in seen if s == scale]
        assert runs[0] == runs[1] == runs[2]


def test_pages_are_conserved(spark):
    rows, df = books(spark)
    days = T._book_days(df, "username", "started_reading", "read_at", "num_pages", "title", None).collect()
    per_book = {}
    for r in days:
        per_book[r.title] = per_book.get(r.title, 0) + Fraction(r.num_pages * r._halves, r._parts)
    assert per_book == {t: n for _, t, _, _, n in rows}
    total = T.pages_per_day(df, scale=None).agg(F.sum("est_pages_read")).first()[0]
    assert abs(total - sum(r[4] for r in rows)) < 1e-6
