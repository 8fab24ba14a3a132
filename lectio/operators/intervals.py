"""Interval -> gap-free daily series with shared-boundary weighting.

A book read from ``start`` to ``end`` (both inclusive) spreads ``amount``
over its days. A boundary day that the same user shares with another
book's finish (on a start) or another book's start (on a finish) counts
half, both in the book's day count and in that day's weight, so the
daily contributions of each book still sum to its amount. One-day books
ignore sharing for themselves (weight 1, one effective day) but their date
still flags other books.

Plan shape (Spark-first):

* boundary flags: ONE aggregation of (user, day) -> start/finish bits over
  the union of start and finish days, read by two equi left joins on
  (user, day) (right side unique per key, so no fan-out) and by the spine
  bounds; its shuffle is computed once and reused. The right side grows
  with the data, so no broadcast is forced; AQE switches to a broadcast
  at run time only when the measured size is under the threshold, and
  splits skewed (user, day) keys on the book side.
* days: ``explode(sequence(start, end))`` - rows = sum of interval lengths.
  For the daily sums a book moves once per ``CHUNK_DAYS`` days, to the task
  of its (user, chunk); its days there are generated after that and summed
  by (user, day) where they are, so they are never shuffled.
* gap fill: a per-user window over interval ends (rows bounded
  by calendar days) finds each gap, one row with its number of days. The
  zero days are generated locally, last and by all tasks, never shuffled.
* book rows are only shuffled by (user, day) or (user, chunk of days); the
  per-user window sees aggregated rows, at most one per calendar day, so one
  user holding a third of the books still spreads over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _c(name: str) -> Column:
    return F.col(name)


def complete_intervals(df: DataFrame, start: str = "started_reading", end: str = "read_at",
                       amount: str = "num_pages", max_days: int | None = None) -> DataFrame:
    """start, end, amount present, amount > 0 and start <= end.
    (Inverted intervals go to the skipped report instead of running a
    backwards sequence or dividing by zero.) ``max_days`` optionally sends
    implausibly long intervals (one bad year explodes into hundreds of
    thousands of rows) to the report as well; off by default."""
    return df.filter(skip_reason(start, end, amount, max_days).isNull())


def skip_reason(start: str = "started_reading", end: str = "read_at",
                amount: str = "num_pages", max_days: int | None = None) -> Column:
    """Why a row is not modelled; NULL when it is."""
    r = (F.when(_c(start).isNull(), F.lit("missing_start"))
         .when(_c(end).isNull(), F.lit("missing_finish"))
         .when(_c(amount).isNull(), F.lit("missing_amount"))
         .when(_c(amount) <= 0, F.lit("non_positive_amount"))
         .when(_c(start) > _c(end), F.lit("inverted_interval")))
    if max_days is not None:
        r = r.when(F.datediff(_c(end), _c(start)) + 1 > max_days, F.lit("interval_too_long"))
    return r


def skipped_intervals(df: DataFrame, start: str = "started_reading", end: str = "read_at",
                      amount: str = "num_pages", cols: list[str] | None = None,
                      max_days: int | None = None) -> DataFrame:
    """exact complement of :func:`complete_intervals`, with a reason."""
    cols = cols if cols is not None else ["title", start, end, amount]
    reason = skip_reason(start, end, amount, max_days)
    return df.select(*cols, reason.alias("reason")).filter(F.col("reason").isNotNull())


def boundary_days(df: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """(key, day, bits) with one row per (key, day); bit 1 = some book
    starts that day, bit 2 = some book finishes that day.

    Both flags live in ONE aggregate column that every consumer reads, so
    Catalyst cannot prune the aggregate differently per consumer and the
    shuffle below it is computed once and reused by both flag joins and
    the spine bounds (one scan of the books instead of three)."""
    days = df.select(
        _c(key).alias("_b_key"),
        F.explode(F.array(
            F.struct(_c(start).alias("day"), F.lit(1).alias("bit")),
            F.struct(_c(end).alias("day"), F.lit(2).alias("bit")),
        )).alias("_b"))
    return (days.groupBy("_b_key", F.col("_b.day").alias("_b_day"))
            .agg(F.bit_or("_b.bit").alias("_b_bits")))


def _has(bits: Column, bit: int) -> Column:
    return F.coalesce(bits.bitwiseAND(F.lit(bit)) != 0, F.lit(False))


def flag_shared_boundaries(df: DataFrame, key: str = "username", start: str = "started_reading",
                           end: str = "read_at", boundaries: DataFrame | None = None) -> DataFrame:
    """``start_shares_finish`` / ``finish_shares_start`` per row.

    Both joins read the SAME boundary aggregate, unique per (key, day), so
    neither fans out. Keys are matched null-safely with an explicit
    "left key not NULL" condition: a NULL user still never matches (as
    with plain equality), but no not-NULL filter is inferred and pushed
    into the shared aggregate, which keeps its subtree identical for reuse."""
    b = boundaries if boundaries is not None else boundary_days(df, key, start, end)
    s_, f_ = b.alias("_s"), b.alias("_f")
    on_s = (_c(key).eqNullSafe(_c("_s._b_key")) & _c(start).eqNullSafe(_c("_s._b_day"))
            & _c(key).isNotNull() & _c(start).isNotNull())
    out = (df.join(s_, on_s, "left")
             .select(df["*"], _has(_c("_s._b_bits"), 2).alias("start_shares_finish")))
    on_f = (_c(key).eqNullSafe(_c("_f._b_key")) & _c(end).eqNullSafe(_c("_f._b_day"))
            & _c(key).isNotNull() & _c(end).isNotNull())
    out = out.join(f_, on_f, "left")
    return out.select(*[_c(f"`{c}`") for c in df.columns], "start_shares_finish",
                      _has(_c("_f._b_bits"), 1).alias("finish_shares_start"))


def effective_days(start: str = "started_reading", end: str = "read_at") -> Column:
    """T4: calendar days minus half a day per shared boundary; a one-day
    book always counts one day."""
    span = F.datediff(_c(end), _c(start)) + 1
    shared = _c("start_shares_finish").cast("int") + _c("finish_shares_start").cast("int")
    return F.when(span == 1, F.lit(1.0)).otherwise(span.cast("double") - F.lit(0.5) * shared)


def day_weight(day: Column, start: str = "started_reading", end: str = "read_at") -> Column:
    """A multi-day book's shared start or shared finish day weighs
    half; every other day (and a one-day book's only day) weighs one."""
    on_shared_boundary = (((day == _c(start)) & _c("start_shares_finish"))
                          | ((day == _c(end)) & _c("finish_shares_start")))
    return F.when((_c(start) != _c(end)) & on_shared_boundary, F.lit(0.5)).otherwise(F.lit(1.0))


def half_days(start: str = "started_reading", end: str = "read_at") -> Column:
    """Twice the effective days (T4), a whole number."""
    return (2 * effective_days(start, end)).cast("long")


def day_halves(day: Column, start: str = "started_reading", end: str = "read_at") -> Column:
    """Twice a day's weight (T6): 1 or 2."""
    return (2 * day_weight(day, start, end)).cast("long")


#: Decimal places of the exact part sums: the units of one share that may be
#: lost by cutting it are far below any rounding that follows.
SHARE_SCALE = 12


def exact_total(amount: Column, halves: Column, parts: Column, scale: int | None) -> Column:
    """Aggregate: the sum of ``amount * halves / parts``, which does not
    depend on the order in which Spark adds the rows.

    Each share is a whole quotient plus a remainder over ``parts``; quotients
    are added as whole numbers, remainders as decimals cut at ``SHARE_SCALE``
    places, and the sum is rounded once, half up (``scale`` None: not)."""
    units = amount.cast("long") * halves
    rest = F.pmod(units, parts)
    whole = F.call_function("div", units - rest, parts)
    total = F.sum(whole).cast(f"decimal(38,{SHARE_SCALE})") + F.sum(
        (rest.cast("decimal(19,0)") / parts.cast("decimal(19,0)")).cast(f"decimal(20,{SHARE_SCALE})")).cast(f"decimal(38,{SHARE_SCALE})")
    return (total if scale is None else F.round(total, scale)).cast("double")


def allocate_daily(complete: DataFrame, key: str = "username", start: str = "started_reading",
                   end: str = "read_at", amount: str = "num_pages",
                   label: str = "title", boundaries: DataFrame | None = None) -> DataFrame:
    """One row per (key, day, label) with the day's share."""
    days = _book_days(complete, key, start, end, amount, label, boundaries)
    share = _c(amount) * (F.col("_halves") / F.lit(2.0)) / (F.col("_parts") / F.lit(2.0))
    return days.select(_c(key), F.col("date"), _c(label), share.alias("pages_per_day"))


#: Calendar days whose books go to one task together (:func:`_book_days`).
CHUNK_DAYS = 16


def _book_days(complete: DataFrame, key: str, start: str, end: str, amount: str, label: str,
               boundaries: DataFrame | None, chunks: bool = False) -> DataFrame:
    """One row per (key, day, label): the amount, and the day's share of it
    as ``_halves`` of ``_parts``.

    With ``chunks``, the rows lie by (key, ``_chunk``), the chunk of
    ``CHUNK_DAYS`` calendar days that holds the day: a book is moved once per
    chunk that it touches, its days are generated there."""
    flagged = flag_shared_boundaries(complete, key, start, end, boundaries)
    books = flagged.select(key, start, end, amount, label, "start_shares_finish", "finish_shares_start",
                           half_days(start, end).alias("_parts"))
    first, last, chunk = _c(start), _c(end), []
    if chunks:
        of = lambda day: F.floor(F.unix_date(day) / CHUNK_DAYS).cast("int")
        books = spread(books.select("*", F.explode(F.sequence(of(first), of(last))).alias("_chunk")), key, "_chunk")
        opens, chunk = F.date_from_unix_date(F.col("_chunk") * CHUNK_DAYS), ["_chunk"]
        first, last = F.greatest(first, opens), F.least(last, F.date_add(opens, CHUNK_DAYS - 1))
    days = books.select("*", F.explode(F.sequence(first, last)).alias("date"))
    return days.select(key, *chunk, "date", label, amount, "_parts", day_halves(F.col("date"), start, end).alias("_halves"))


def date_spine(complete: DataFrame, key: str = "username", start: str = "started_reading",
               end: str = "read_at", boundaries: DataFrame | None = None) -> DataFrame:
    """Every day between a user's first start and last finish.

    With ``boundaries`` (the T1 aggregate of start-<=-end rows) the bounds
    come from it: min over starts and finishes is the first start, max is
    the last finish, and no second scan of the books is needed."""
    if boundaries is not None:
        # Reading _b_bits keeps the shared aggregate intact (see boundary_days).
        seen = lambda c: F.when(F.col("_b_bits") > 0, F.col(c))
        bounds = boundaries.groupBy(F.col("_b_key").alias(key)).agg(
            F.min(seen("_b_day")).alias("first_date"), F.max(seen("_b_day")).alias("last_date"))
    else:
        bounds = complete.groupBy(key).agg(F.min(start).alias("first_date"),
                                           F.max(end).alias("last_date"))
    return bounds.select(key, F.explode(F.sequence("first_date", "last_date")).alias("date"))


def round_half_up(c: Column, scale: int) -> Column:
    """round() through DECIMAL so ties resolve identically on every engine
    (a zero, most of a gap-free series, is left as it is)."""
    return F.when(c == 0, F.lit(0.0)).otherwise(F.round(c.cast("decimal(38,12)"), scale).cast("double"))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` by ``keys`` over all shuffle partitions. For rows that are few
    and small here but expand into many: adaptive execution would merge
    them by their bytes into a task or two."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def each_day(runs: DataFrame, rising: str | None = None, day: str = "date", days: str = "n_days") -> DataFrame:
    """One row per day of rows that stand for ``days`` days from ``day`` on;
    ``rising`` names a column that grows by one a day. Rows don't move."""
    every = F.posexplode(F.sequence(_c(day), F.date_add(_c(day), _c(days) - 1))).alias("_at", "_day")
    named = {day: _c("_day"), **({rising: _c(rising) + _c("_at")} if rising else {})}
    kept = [c for c in runs.columns if c != days]
    return runs.select(*[c for c in kept if c != day], every).select(*[named.get(c, _c(f"`{c}`")).alias(c) for c in kept])


def gap_runs(complete: DataFrame, key: str = "username", start: str = "started_reading",
             end: str = "read_at") -> DataFrame:
    """(key, date, n_days): the stretches between a user's first start and
    last finish on which no book is open, by first day and length.

    Only interval ends move, never titles: per user and start day the latest
    finish is kept (partial aggregation), and a window per user, at most one
    row per calendar day, finds where the running latest finish ends before
    the next start."""
    spans = spread(complete.groupBy(key, start).agg(F.max(end).alias("_until")), key)
    w = Window.partitionBy(key).orderBy(start).rowsBetween(Window.unboundedPreceding, -1)
    gaps = spans.select(key, _c(start).alias("_next"), F.max("_until").over(w).alias("_last"))
    gaps = gaps.where(F.datediff("_next", "_last") > 1)
    return gaps.select(key, F.date_add("_last", 1).alias("date"), (F.datediff("_next", "_last") - 1).alias("n_days"))


def gap_days(complete: DataFrame, key: str = "username", start: str = "started_reading",
             end: str = "read_at") -> DataFrame:
    """(key, date): every day of :func:`gap_runs`."""
    return each_day(gap_runs(complete, key, start, end))


def pages_per_day(books: DataFrame, key: str = "username", start: str = "started_reading",
                  end: str = "read_at", amount: str = "num_pages", label: str = "title",
                  complete: bool = False, max_days: int | None = None, scale: int | None = 1) -> DataFrame:
    """Gold daily series (T1-T10, A2-A4, A8):
    (key, date, est_pages_read double, books_in_progress array<string>), the
    days of :func:`daily_runs`."""
    return each_day(daily_runs(books, key, start, end, amount, label, complete, max_days, scale))


def daily_runs(books: DataFrame, key: str = "username", start: str = "started_reading",
               end: str = "read_at", amount: str = "num_pages", label: str = "title",
               complete: bool = False, max_days: int | None = None, scale: int | None = 1) -> DataFrame:
    """The gold series with its gaps unexpanded: (key, date, n_days,
    est_pages_read, books_in_progress), one row per day on which a book is
    open (``n_days`` 1) and one per gap. Most days of a sparse reader are gap
    days; what a row needs before it is expanded (:func:`each_day`) is done
    and moved once per gap.

    The sums are exact (:func:`exact_total`): they don't change with the
    number of shuffle partitions. ``complete=True`` skips the completeness
    filter when the caller already applied it. The title list of a (user, day) is the output row
    itself: it holds every book that user has open that day, in full.
    ``scale`` rounds the day's sum (None: unrounded).

    Gap fill without a spine join: every day of every book is a
    contribution day, so the zero days are exactly the gaps between a
    user's intervals (:func:`gap_runs`). They are appended to the (user,
    day) totals, which stay where their aggregation put them, so a user
    with a third of all books spreads over every task. A NULL user never
    matches in the reference's spine join, so its contributions count as
    zero."""
    ok = books if complete else complete_intervals(books, start, end, amount, max_days)
    ok = ok.select(key, start, end, amount, label)
    b = boundary_days(ok, key, start, end)
    contrib = _book_days(ok, key, start, end, amount, label, b, chunks=True)
    null_user = _c(key).isNull()
    contrib = contrib.select(
        key, "_chunk", "date", "_halves", "_parts",
        F.when(null_user, F.lit(0)).otherwise(_c(amount)).alias("_amount"),
        F.when(null_user, F.lit(None).cast("string")).otherwise(_c(label)).alias(label))
    days = contrib.groupBy(key, "_chunk", "date").agg(
        exact_total(F.col("_amount"), F.col("_halves"), F.col("_parts"), scale).alias("est_pages_read"),
        F.sort_array(F.collect_list(label)).alias("books_in_progress"))
    zero = gap_runs(ok, key, start, end).select(
        key, "date", "n_days", F.lit(0.0).alias("est_pages_read"), F.array().cast("array<string>").alias("books_in_progress"))
    return days.select(key, "date", F.lit(1).alias("n_days"), "est_pages_read", "books_in_progress").unionByName(zero)
