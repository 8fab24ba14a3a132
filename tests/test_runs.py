"""The gold series with a row per gap: whole results, few rows moved, many tasks."""

import contextlib
import datetime as dt
import random
import time

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lectio.operators import intervals as T
from lectio.operators import metrics as M
from lectio.plans.queries import QUERIES
from lectio.session import shuffles_removed

from .conftest import SF001

DAY0 = dt.date(2020, 1, 1)


@pytest.fixture(scope="module")
def books(spark):
    rng, rows = random.Random(5), []
    for i in range(160):
        user = rng.choice([f"u{k}" for k in range(12)] + [None])
        start = DAY0 + dt.timedelta(rng.randrange(900))
        rows.append((user, f"t{i}", start, start + dt.timedelta(rng.choice([0, 1, 3, 8, 40])), rng.randrange(1, 500)))
    return spark.createDataFrame(rows, "username string, title string, started_reading date, read_at date, num_pages int")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def dense(books):
    return T.pages_per_day(books, scale=None)


def test_a_gap_is_one_row(books):
    runs, ok = T.daily_runs(books, scale=None), books.select("username", F.explode(F.sequence("started_reading", "read_at")).alias("date")).distinct()
    days = ok.groupBy("username").agg(F.min("date").alias("lo"), F.max("date").alias("hi"), F.count("date").alias("n"))
    whole = days.agg(F.sum(F.datediff("hi", "lo") + 1)).first()[0]
    assert dense(books).count() == runs.agg(F.sum("n_days")).first()[0] == whole > 4 * runs.count()
    assert runs.where("n_days > 1 and (est_pages_read <> 0 or size(books_in_progress) > 0)").count() == 0


def test_gaps_are_expanded_by_many_tasks(books):
    """Their rows are few: by bytes, they would be merged into one task."""
    assert T.gap_days(books).select(F.spark_partition_id()).distinct().count() > 3


@pytest.mark.parametrize("n", [1, 2, 7, 30, 400])
@pytest.mark.parametrize("bounds", [(None, None), ("2020-03-05", "2021-04-01"), (None, "2020-12-31"), ("2021-01-01", None)])
def test_rolling_mean_of_runs_equals_that_of_days(books, n, bounds):
    want = M.rolling_mean(M.date_range(dense(books), *bounds), n)
    got = M.rolling_mean(M.date_range(T.daily_runs(books, scale=None), *bounds, days="n_days"), n, days="n_days")
    assert got.columns == want.columns
    assert rows_of(got) == rows_of(want)


def test_positions_of_runs_equal_those_of_days(books):
    want = M.daily_view(dense(books)).withColumn("position", F.row_number().over(Window.orderBy("username", "date")).cast("long"))
    v = M.daily_view(T.daily_runs(books, scale=None), ordered=True, days="n_days")
    got = T.each_day(v, rising="position").select(want.columns)
    assert rows_of(got) == rows_of(want)


@pytest.mark.parametrize("name", ["daily_ordered", "rolling_mean_7", "rolling_mean_range"])
def test_zero_days_are_expanded_after_the_last_exchange(spark, name):
    lines = QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString().splitlines()
    last = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    assert any("sequence(" in line for line in lines[:last])


def test_labels_and_titles_are_made_before_days(spark):
    for name in ("daily_view", "labels_joined", "daily_allocation"):
        lines = QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString().splitlines()
        join = next(i for i, line in enumerate(lines) if "array_join" in line)
        assert any("sequence(" in line for line in lines[:join]), name


def test_sparse_report_holds_every_day(spark):
    got = QUERIES["daily_allocation_sparse"](spark, SF001)
    assert got.columns == ["username", "date", "est_pages_read", "n_books", "book_titles"]
    assert got.where("n_books > 0").count() > 0 < got.where("n_books = 0").count()
    assert got.exceptAll(QUERIES["daily_allocation"](spark, SF001)).count() == 0


def test_days_of_a_chunk_are_those_of_the_books(spark):
    rng, rows = random.Random(9), []
    for i in range(120):
        start = dt.date(1969, 6, 1) + dt.timedelta(rng.randrange(400))
        rows.append((rng.choice(["a", "b", None]), f"t{i}", start, start + dt.timedelta(rng.choice([0, 1, 15, 16, 17, 90, 700])), rng.randrange(1, 500)))
    df = spark.createDataFrame(rows, "username string, title string, started_reading date, read_at date, num_pages int")
    cols = ("username", "started_reading", "read_at", "num_pages", "title", None)
    days = T._book_days(df, *cols, chunks=True)
    assert rows_of(days.drop("_chunk")) == rows_of(T._book_days(df, *cols))
    assert days.where(F.floor(F.datediff("date", F.lit("1970-01-01").cast("date")) / T.CHUNK_DAYS) != F.col("_chunk")).count() == 0


def test_book_days_are_made_after_they_are_dealt(books):
    """Shuffled as days, a book is moved as often as it has days."""
    plan = T.daily_runs(books)._jdf.queryExecution().executedPlan().toString().splitlines()
    dealt = next(i for i, line in enumerate(plan) if "Exchange hashpartitioning(username" in line and "_chunk" in line)
    assert any("explode(sequence(greatest(" in line for line in plan[:dealt])


@pytest.mark.parametrize("parts", ["1", "8"])
def test_positions_of_series(spark, parts):
    rng, rows = random.Random(6), []
    for user in [None, "", "a", "b", "c", "é", "hot"]:
        day = DAY0
        for _ in range(90 if user == "hot" else rng.randrange(1, 9)):
            n = rng.choice([1, 1, 2, 40])
            rows.append((user, day, n, rng.random()))
            day += dt.timedelta(n + rng.randrange(3))
    want, at = [], 1
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1])):
        want.append((*r, at))
        at += r[2]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "username string, date date, n_days int, v double").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = M.numbered_series(df, "username", "date", days="n_days")
        assert got.dtypes == [*df.dtypes, ("position", "bigint")]
        assert sorted(map(tuple, got.collect()), key=lambda r: r[-1]) == want
        assert M.numbered_series(df.limit(0), "username", "date", days="n_days").count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_an_ordered_read_runs_its_input_once(spark, books):
    runs = T.daily_runs(books, scale=None).localCheckpoint()
    seen = spark.sparkContext.accumulator(0)
    tick = F.udf(lambda n: seen.add(1) or n, "int")
    v = M.daily_view(runs.withColumn("n_days", tick("n_days")), ordered=True, days="n_days")
    assert v.count() == runs.count() == seen.value


def test_an_ordered_read_without_titles(books):
    runs = T.daily_runs(books, scale=None)
    whole, v = (M.daily_view(runs, ordered=True, days="n_days", titles=t) for t in (True, False))
    assert "book_titles" in whole.columns and "book_titles" not in v.columns
    assert rows_of(v) == rows_of(whole.drop("book_titles"))


def test_daily_ordered_stores_no_titles(spark):
    stored = spark.read.option("mergeSchema", "true").parquet(*QUERIES["daily_ordered"](spark, SF001).inputFiles())
    assert "est_pages_read" in stored.columns and "book_titles" not in stored.columns


def test_shuffle_files_go_with_the_write(spark, tmpdir_path):
    def held():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {f for f in files.split("\n") if "/shuffle_" in f}

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    for name, removed in (("kept", False), ("removed", True)):
        before, conf = held(), spark.conf.get(key)
        df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
        with shuffles_removed(spark) if removed else contextlib.nullcontext():
            df.write.parquet(f"{tmpdir_path}/{name}")
        until = time.time() + 10
        while removed and held() - before and time.time() < until:
            time.sleep(0.1)
        assert bool(held() - before) != removed
        assert spark.conf.get(key) == conf
        assert spark.read.parquet(f"{tmpdir_path}/{name}").count() == 7
