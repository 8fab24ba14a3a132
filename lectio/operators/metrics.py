"""Serving-side analytics on the gold tables.

What a dashboard did in pandas after pulling the whole table runs here as
one lazy plan: ``daily_view -> date_range -> rolling_mean``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from lectio.functions.text import bullet_list, once
from lectio.operators.intervals import spread
from lectio.session import scratch_path, shuffles_removed


def date_range(df: DataFrame, start: str | _dt.date | None = None,
               end: str | _dt.date | None = None, col: str = "date", days: str | None = None) -> DataFrame:
    """inclusive bounds, either optional. Pushed to the scan when
    ``df`` is a stored gold table. Rows that stand for ``days`` days
    (:func:`lectio.operators.intervals.daily_runs`) are cut to the range."""
    first, last = F.col(col), F.col(col) if days is None else F.date_add(col, F.col(days) - 1)
    low, high = (None if d is None else F.lit(d).cast("date") for d in (start, end))
    if low is not None:
        df = df.filter(last >= low)
    if high is not None:
        df = df.filter(first <= high)
    if days is not None and not (low is None and high is None):
        begin = first if low is None else F.greatest(first, low)
        df = df.withColumns({col: begin, days: F.datediff(last if high is None else F.least(last, high), begin) + 1})
    return df


def rolling_mean(df: DataFrame, n: int = 7, value: str = "est_pages_read",
                 key: str = "username", order: str = "date", out: str = "rolling_mean", days: str | None = None) -> DataFrame:
    """Mean over the last ``n`` rows per user, partial windows at the
    start. Apply after :func:`date_range` (no look-back past the left
    edge). The window partitions by user; a user's partition holds one row
    per calendar day of their span, so it is bounded by days, not by the
    number of books read.

    With ``days``, ``df`` is a gap-free series whose gaps are one row each
    (:func:`lectio.operators.intervals.daily_runs`); the result has a row
    per day all the same."""
    if n < 1:
        raise ValueError("the window needs at least one row")
    if days is not None:
        return _rolling_runs(df, n, value, key, order, out, days)
    w = Window.partitionBy(key).orderBy(order).rowsBetween(-(n - 1), 0)
    return df.withColumn(out, F.avg(value).over(w))


def _rolling_runs(df: DataFrame, n: int, value: str, key: str, order: str, out: str, days: str) -> DataFrame:
    """A row's window holds the values of the ``n`` days up to its first. In
    a gap the sum changes only on the days on which one of them leaves, so a
    gap falls into pieces of equal sum, which are expanded last."""
    at = F.unix_date(order)
    w = Window.partitionBy(key).orderBy(at)
    before = F.sum(days).over(w.rowsBetween(Window.unboundedPreceding, -1))
    seen = F.collect_list(F.struct(at.alias("day"), F.col(value).alias("value"))).over(w.rangeBetween(-(n - 1), 0))
    rows = spread(df, key).withColumns({"_before": F.coalesce(before, F.lit(0)), "_seen": seen, "_first": at})
    first, last = F.col("_first"), F.col("_first") + F.col(days) - 1
    held = F.filter("_seen", lambda x: x["value"] != 0)
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda acc, x: acc + x["value"])
    piece = lambda a, b, s: F.struct(a.alias("from"), b.alias("to"), s.alias("sum"))

    def pieces(xs: Column) -> Column:
        k = F.size(xs)
        def nth(i: Column) -> Column:  # the first day without the first i values, the last of piece i - 1 being the day before
            return F.when(i == 0, first).when(i > k, last + 1).otherwise(F.try_element_at(xs, F.greatest(i, F.lit(1)))["day"] + n)
        every = F.transform(F.sequence(F.lit(0), k), lambda i: piece(
            nth(i), F.least(nth(i + 1) - 1, last), total(F.slice(xs, i + 1, k - i))))
        return F.filter(every, lambda p: p["from"] <= last)

    parts = F.when(F.col(days) == 1, F.array(piece(first, last, total(F.col("_seen"))))).otherwise(once(held, pieces))
    others = [c for c in df.columns if c not in (order, days)]
    split = rows.select(*others, "_before", "_first", F.inline(parts))
    daily = split.select(*others, "_before", "_first", "sum", F.explode(F.sequence("from", "to")).alias("_at"))
    rank = F.col("_before") + F.col("_at") - F.col("_first") + 1
    named = {order: F.date_from_unix_date("_at")}
    return daily.select(*[named.get(c, F.col(f"`{c}`")).alias(c) for c in df.columns if c != days],
                        (F.col("sum") / F.least(rank, F.lit(n)).cast("double")).alias(out))


def numbered(df: DataFrame, *order: Column | str, name: str = "position", days: str | None = None) -> DataFrame:
    """``df`` in the global order of ``order``, each row with its
    ``position`` from 1.

    No task sees all rows: they are range-sorted and written once (the
    ranges, and which row is in which, are then fixed), every file's rows are
    numbered where they are, and a file's numbers begin after the count of
    all rows in files before it. Only the counts, one per range, pass through
    a window without a partition. Rows that tie on ``order`` have positions
    next to each other in no certain order; name enough columns.

    With ``days``, a row stands for that many rows next to each other, and
    has the position of the first: the days before it in its range are added
    up by a window over the range."""
    spark = df.sparkSession
    path = scratch_path(spark, "ordered")
    part, row = "_range", "_at"
    by = [F.col(c) if isinstance(c, str) else c for c in order]
    ranges = [] if days is None else [int(spark.conf.get("spark.sql.shuffle.partitions"))]  # kept apart: rows will expand
    ranged = df.repartitionByRange(*ranges, *by).sortWithinPartitions(*order)
    # the number within a range is the row's place in its task, taken as it is written
    (ranged.withColumn(part, F.spark_partition_id()).withColumn(row, F.monotonically_increasing_id())
     .write.parquet(path))
    rows = spark.read.schema(StructType([*df.schema.fields, StructField(part, IntegerType()), StructField(row, LongType())])).parquet(path)
    counts = rows.groupBy(part).agg((F.count(F.lit(1)) if days is None else F.sum(days)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(F.col(part).alias("_of"), F.coalesce(before, F.lit(0)).alias("_before"))
    if days is None:
        inside = F.col(row).bitwiseAND(F.lit(2**33 - 1))
    else:
        earlier = F.sum(days).over(Window.partitionBy(part).orderBy(row).rowsBetween(Window.unboundedPreceding, -1))
        rows, inside = spread(rows, part).withColumn("_inside", F.coalesce(earlier, F.lit(0))), F.col("_inside")
    placed = rows.join(offsets, F.col(part) == F.col("_of"))
    return placed.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_before") + inside + 1).alias(name))


def numbered_series(df: DataFrame, series: str, *order: str, days: str, name: str = "position") -> DataFrame:
    """:func:`numbered` by ``series`` and ``order`` for rows that stand for
    ``days`` rows each and are few per series (a user's runs of days: one per
    calendar day at most).

    Only the series are range-sorted, each with its days in all. The rows are
    written as they come (the sums and the result read the same rows, and
    what made them runs once) and moved once, to their series, where the days
    before a row are added to the series' first position."""
    path = scratch_path(df.sparkSession, "series")
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    rows = df.sparkSession.read.schema(df.schema).parquet(path)
    first = numbered(rows.groupBy(series).agg(F.sum(days).alias("_days")), series, name="_first", days="_days")
    # a series' first position comes as a row before its others: no join
    both = spread(rows.unionByName(first.select(series, "_first"), allowMissingColumns=True), series)
    w = Window.partitionBy(series).orderBy(F.col("_first").asc_nulls_last(), *order).rowsBetween(Window.unboundedPreceding, -1)
    placed = both.withColumn(name, F.sum(F.coalesce("_first", days)).over(w)).where(F.col("_first").isNull())
    return placed.select(*[F.col(f"`{c}`") for c in df.columns], name)


def daily_view(gold_daily: DataFrame, ordered: bool = False, days: str | None = None, titles: bool = True) -> DataFrame:
    """Count of books in progress plus the list as ``book_titles``.
    ``ordered`` adds the ``position`` of a dashboard read in (username, date)
    order (R2); leave it off when the consumer needs no global order. Rows
    that stand for ``days`` days keep that column. An ordered read stores and
    moves every column: without ``titles`` the list is left out, for a
    consumer that shows the count alone."""
    v = gold_daily.select(
        "username", "date", *([] if days is None else [days]), "est_pages_read",
        F.size("books_in_progress").alias("books_in_progress"),
        *([F.col("books_in_progress").alias("book_titles")] if titles else []))
    if not ordered:
        return v
    return numbered(v, "username", "date") if days is None else numbered_series(v, "username", "date", days=days)


def genre_view(gold_genre: DataFrame, ordered: bool = False) -> DataFrame:
    """Typed projection of the genre gold table (R2 ``position`` in
    (username, genre) order optional)."""
    v = gold_genre.select(
        "username", "genre", F.col("avg_user_rating").cast("double").alias("avg_user_rating"),
        F.col("total_pages").cast("int").alias("total_pages"),
        F.col("book_count").cast("int").alias("book_count"))
    return numbered(v, "username", "genre") if ordered else v


def date_domain(df: DataFrame, col: str = "date") -> DataFrame:
    """D3: (min_date, max_date)."""
    return df.agg(F.min(col).alias("min_date"), F.max(col).alias("max_date"))


def title_labels(df: DataFrame, titles: str = "book_titles", out: str = "titles_label") -> DataFrame:
    """``• a<br>• b`` hover label."""
    return df.withColumn(out, bullet_list(F.col(titles)))


def dense_matrix(summary: DataFrame, key: str = "username", label: str = "genre",
                 metrics: tuple[str, ...] = ("avg_user_rating", "total_pages", "book_count"),
                 ) -> DataFrame:
    """Every (user, genre) pair for the genres that any user has; absent
    metrics are 0.

    The genre axis is read from the summary by a scalar subquery (one list,
    as wide as the matrix itself) and exploded per user; users are never
    paired with each other or with rows of the summary."""
    axis = summary.select(F.sort_array(F.collect_set(label))).scalar()
    grid = summary.select(key).distinct().select(key, F.explode(axis).alias(label))
    filled = grid.join(summary, [key, label], "left")
    return filled.select(key, label, *[F.coalesce(F.col(m), F.lit(0)).alias(m) for m in metrics])


def metric_long(df: DataFrame, key: tuple[str, ...] = ("username", "genre"),
                metrics: tuple[str, ...] = ("avg_user_rating", "total_pages", "book_count"),
                pick: str | None = None) -> DataFrame:
    """(key..., metric, value double); optionally one chosen metric."""
    cast = df.select(*key, *[F.col(m).cast("double").alias(m) for m in metrics])
    long = cast.unpivot(list(key), list(metrics), "metric", "value")
    return long.filter(F.col("metric") == pick) if pick else long
