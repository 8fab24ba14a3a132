"""Registered queries: each takes (spark, sf_dir) and returns a lazy
DataFrame over the whole driver tables (or frames Spark derives from
them). Arrays are emitted sorted and joined with '|' so results compare
by value across engines; doubles are rounded half-up through DECIMAL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectio.functions.bib import parse_bib_record
from lectio.functions.dates import parse_flexible_date
from lectio.functions.html import extract_labelled
from lectio.functions.text import decode_json_array
from lectio.operators import genre as G
from lectio.operators import intervals as T
from lectio.operators import metrics as M
from lectio.operators.batches import latest_batch, latest_written, stamp_batch
from lectio.operators.classify import Rule, classify
from lectio.operators.cleaning import clean_books, date_rejects
from lectio.operators.enrich import enrich_books, start_dates
from lectio.operators.lookups import lookup_keys, plan_lookups, resolve_lookups
from lectio.operators.quality import lookup_errors, lookup_status, read_metrics, validate_pages
from lectio.plans import derive as D
from lectio.plans import stages
from lectio.schemas import BRONZE_RSS
from lectio.session import scratch_path
from lectio.sources.catalog import append_batch, ensure_schema, latest_of
from lectio.sources.feed import scan_feed
from lectio.sources.landing import land_pages
from lectio.sources.sinks import append_bronze, overwrite_table
from lectio.sources.tables import latest_bronze, read_bronze, read_table

# Keyword rules of the part catalogue (label, substrings,
# whole values, prefixes), the driver-table counterpart of the genre rules.
PART_RULES = [
    Rule("Fastener", ("bolt",), ("small ring", "large ring")),
    Rule("Machinery", ("gear", "gizmo", "widget")),
    Rule("Heavy", ("anvil", "plate"), (), ("large",)),
    Rule("Thermal", (), (), ("hot", "cold")),
    Rule("Colour", (), (), ("red", "blue")),
    Rule("Bargain", (), ("economy", "promo")),
]

RANGE_START, RANGE_END, RANGE_WINDOW = "1996-01-01", "1997-12-31", 30


def joined(c: Column) -> Column:
    return F.array_join(F.sort_array(c), "|")


def rnd(c: Column, scale: int) -> Column:
    return T.round_half_up(c, scale)


# -- interval allocation -------------------------------------------------

def _gold_runs(spark: SparkSession, base: str, user: str = "customer") -> DataFrame:
    """The gold series, its gaps unexpanded, its sums rounded through
    DECIMAL as the SQL does."""
    g = T.daily_runs(D.readings(spark, base, user=user), scale=None)
    return g.withColumn("est_pages_read", rnd(F.col("est_pages_read"), 1))


def _daily_report(g: DataFrame) -> DataFrame:
    return T.each_day(g.select("username", "date", "n_days", "est_pages_read",
                               F.size("books_in_progress").alias("n_books"),
                               joined(F.col("books_in_progress")).alias("book_titles")))


def q_daily_allocation(spark, base):
    return _daily_report(_gold_runs(spark, base))


def q_daily_allocation_sparse(spark, base):
    """Few books per user over long spans: the output is dominated by
    gap-filled zero days."""
    return _daily_report(_gold_runs(spark, base, user="customer"))


def q_daily_allocation_dense(spark, base):
    """Nations as users: every day of a user has many open books."""
    return _daily_report(_gold_runs(spark, base, user="nation"))


def q_shared_boundaries(spark, base):
    ok = T.complete_intervals(D.readings(spark, base))
    f = T.flag_shared_boundaries(ok)
    return f.select("username", "title", "started_reading", "read_at", "start_shares_finish",
                    "finish_shares_start", T.effective_days().alias("effective_reading_days"))


def q_skipped_report(spark, base):
    return T.skipped_intervals(D.readings(spark, base), cols=["username", "title", "started_reading",
                                                               "read_at", "num_pages"])


def q_rolling_mean_7(spark, base):
    r = M.rolling_mean(_gold_runs(spark, base), 7, days="n_days")
    return r.select("username", "date", "est_pages_read", rnd(F.col("rolling_mean"), 6).alias("rolling_mean"))


def q_rolling_mean_range(spark, base):
    g = M.date_range(_gold_runs(spark, base), RANGE_START, RANGE_END, days="n_days")
    r = M.rolling_mean(g, RANGE_WINDOW, days="n_days")
    return r.select("username", "date", "est_pages_read", rnd(F.col("rolling_mean"), 6).alias("rolling_mean"))


def q_daily_view(spark, base):
    v = M.title_labels(M.daily_view(_gold_runs(spark, base), days="n_days"))
    return T.each_day(v.select("username", "date", "n_days", "est_pages_read", "books_in_progress", "titles_label"))


def q_labels_joined(spark, base):
    """D6 alone: one hover label per user-day, empty where no book is open."""
    v = M.title_labels(M.daily_view(_gold_runs(spark, base), days="n_days"))
    return T.each_day(v.select("username", "date", "n_days", "titles_label"))


def q_daily_ordered(spark, base):
    """R2: the dashboard's ordered read, every row with its position."""
    v = M.daily_view(_gold_runs(spark, base), ordered=True, days="n_days", titles=False)
    return T.each_day(v.select("position", "username", "date", "n_days", "est_pages_read", "books_in_progress"), rising="position")


def q_genre_ordered(spark, base):
    """R2: the genre table's ordered read."""
    return M.genre_view(_genre_summary(spark, base), ordered=True)


def q_daily_rounded(spark, base):
    """A3: the sums as the stages write them, rounded once to one place."""
    g = T.pages_per_day(D.readings(spark, base, user="nation"))
    return g.select("username", "date", "est_pages_read")


def q_date_domain(spark, base):
    return M.date_domain(T.each_day(_gold_runs(spark, base)))


# -- batches, cleaning, parsing ------------------------------------------

def q_latest_batch(spark, base):
    ev = read_table(spark, "events", base).withColumn("_ingested_at", F.date_trunc("day", "ts"))
    snap = latest_batch(ev).filter(F.col("event_type") != "").drop("props")
    return snap.select("event_id", "user_id", "event_type", "value", F.to_date("ts").alias("day"))


def _typed(df: DataFrame) -> DataFrame:
    return df.select("book_id", "title", "username", "num_pages", "year_published", "average_rating",
                     "user_rating", "read_at", "date_added", "is_read")


def q_typed_clean(spark, base):
    return _typed(clean_books(latest_written(D.feed_rows(spark, base)), snapshot=False))


def q_date_parse(spark, base):
    o = read_table(spark, "orders", base).select("o_orderkey", "o_orderdate")
    k = F.col("o_orderkey")
    bad = k % 50 == 0
    long_t = F.when(bad, F.lit("garbage")).otherwise(F.date_format("o_orderdate", "MMMM d, yyyy"))
    rfc_t = F.concat(F.date_format("o_orderdate", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" -0700"))
    iso_t = F.when(k % 7 == 0, F.lit("")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    m = k % 8
    other = (F.when(m == 0, F.date_format("o_orderdate", "M/d/yy")).when(m == 1, F.date_format("o_orderdate", "d MMM yy"))
             .when(m == 2, F.date_format("o_orderdate", "MMM-d-yyyy")).when(m == 3, F.date_format("o_orderdate", "yyyy MMMM d"))
             .when(m == 4, F.date_format("o_orderdate", "EEE MMM d HH:mm:ss yyyy"))
             .when(m == 5, F.concat(F.lit("1"), F.date_format("o_orderdate", "yyyy-MM-dd")))
             .when(m == 6, F.concat(F.date_format("o_orderdate", "MM-dd-yyyy"), F.lit(" 2023-05-06")))
             .otherwise(F.regexp_replace(F.date_format("o_orderdate", "MMM d, yyyy"), "Sep", "Sept")))
    # a clock time in front, a zone inside, spoken dates
    day, m5 = F.col("o_orderdate"), k % 5
    clock = (F.when(m5 == 0, F.concat(F.lit("10:15 "), F.date_format(day, "MMMM d, yyyy")))
             .when(m5 == 1, F.concat(F.date_format(day, "EEE MMM d"), F.lit(" 22:30:00 PDT "), F.date_format(day, "yyyy")))
             .when(m5 == 2, F.concat(F.date_format(day, "EEEE d"), F.lit("th of "), F.date_format(day, "MMMM yyyy")))
             .when(m5 == 3, F.concat(F.lit("10:15:20 "), F.date_format(day, "d MMMM yyyy")))
             .otherwise(F.concat(F.lit("at 22:30 "), F.date_format(day, "M/d/yy"))))
    texts = o.select("o_orderkey", long_t.alias("t_long"), rfc_t.alias("t_rfc"), iso_t.alias("t_iso"), other.alias("t_other"),
                     clock.alias("t_clock"))
    return texts.select("o_orderkey", *(parse_flexible_date(f"t_{c}").alias(f"d_{c}") for c in ("long", "rfc", "iso", "other", "clock")))


def _newest(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("_ingested_at") == F.lit(D.NEW_BATCH).cast("timestamp"))


def _write_feeds(spark, rows: DataFrame) -> list[str]:
    """Two landed XML feeds (even / odd customers) of the given rows."""
    item = rows.select(
        F.col("title"), F.col("author").alias("author_name"), "isbn", "book_id",
        F.struct(F.col("num_pages")).alias("book"), F.col("year_published").alias("book_published"),
        "average_rating", "user_rating", F.col("read_at").alias("user_read_at"),
        F.col("date_added").alias("user_date_added"), F.col("shelves").alias("user_shelves"),
        F.col("review").alias("user_review"), "book_description",
        F.col("cover_url").alias("book_medium_image_url"), F.col("goodreads_url").alias("link"),
        F.col("username").alias("user_name"),
        (F.regexp_extract("username", r"(\d+)$", 1).cast("bigint") % 2).alias("_feed"))
    # One pass writes both feeds: one folder per feed (even / odd customer).
    root = scratch_path(spark, "feeds")
    (item.write.format("xml").option("rootTag", "channel").option("rowTag", "item")
     .partitionBy("_feed").mode("overwrite").save(root))
    return [f"{root}/_feed={part}" for part in (0, 1)]


def q_feed_scan(spark, base):
    """All 16 feed columns of every item of both landed feeds, every fetch."""
    return scan_feed(spark, _write_feeds(spark, D.feed_rows(spark, base)))


def q_feed_to_silver(spark, base):
    """Landed feeds -> bronze (two appended batches) -> newest batch -> silver."""
    bronze = scratch_path(spark, "bronze_rss")
    rows = D.feed_rows(spark, base)
    append_bronze(rows.filter(F.col("_ingested_at") == F.lit(D.OLD_BATCH).cast("timestamp")), bronze)
    scanned = scan_feed(spark, _write_feeds(spark, _newest(rows)))
    append_bronze(stamp_batch(scanned, "rss", D.NEW_BATCH), bronze)
    return _typed(clean_books(latest_bronze(spark, bronze, BRONZE_RSS), snapshot=False))


def q_date_rejects(spark, base):
    return date_rejects(D.feed_rows(spark, base))


def q_silver_overwritten(spark, base):
    """O2: a table replaced by one with another schema holds the last write."""
    path = scratch_path(spark, "silver")
    overwrite_table(D.feed_rows(spark, base).select("book_id"), path)
    overwrite_table(_typed(clean_books(D.feed_rows(spark, base))), path, sort_within=("username", "book_id"))
    return spark.read.parquet(path)


def _scratch_db(spark) -> str:
    """A database of this run's own, in the shared scratch folder."""
    db = f"lectio_{uuid.uuid4().hex}"
    ensure_schema(spark, db, location=scratch_path(spark, "db"))
    return db


def q_silver_switched(spark, base):
    """O2 by name: the table is switched to other columns and then to other
    rows; readers of the name see the last version."""
    name = f"{_scratch_db(spark)}.silver"
    overwrite_table(D.feed_rows(spark, base).select("book_id"), name)
    newest = latest_written(D.feed_rows(spark, base))
    overwrite_table(_typed(clean_books(newest, snapshot=False)).limit(0), name)
    overwrite_table(_typed(clean_books(newest, snapshot=False)), name, sort_within=("username", "book_id"))
    return spark.table(name)


def q_bronze_partitions(spark, base):
    """Two batches of a catalog table, the second with one more
    column; the newest by partition metadata, and how many rows all have."""
    name = f"{_scratch_db(spark)}.bronze"
    rows = D.feed_rows(spark, base).select("book_id", "username", "_ingested_at")
    append_batch(rows.filter(F.col("_ingested_at") == F.lit(D.OLD_BATCH).cast("timestamp")), name, "20240101")
    append_batch(_newest(rows).withColumn("rating_note", F.concat(F.lit("n"), "book_id")), name, "20240102")
    every = spark.table(name).select(F.count(F.lit(1))).scalar()
    return latest_of(spark, name).select("book_id", "username", "rating_note", every.alias("n_history"))


def q_run_metrics(spark, base):
    """The row counts that a run of the first stage wrote, read back."""
    root = scratch_path(spark, "run")
    feeds = _write_feeds(spark, _newest(D.feed_rows(spark, base)))
    stages.books_stage(spark, feeds, f"{root}/bronze_rss", f"{root}/silver_books", D.NEW_BATCH, reports=f"{root}/reports", run="r1")
    return read_metrics(spark, f"{root}/reports/run_metrics")


def q_bronze_widened(spark, base):
    """O1/S3: a later batch with one more column reads back widened."""
    path = scratch_path(spark, "bronze_widened")
    rows = D.feed_rows(spark, base).select("book_id", "username", "_ingested_at")
    append_bronze(rows.filter(F.col("_ingested_at") == F.lit(D.OLD_BATCH).cast("timestamp")), path)
    append_bronze(_newest(rows).withColumn("rating_note", F.concat(F.lit("n"), "book_id")), path)
    return read_bronze(spark, path).select("book_id", "username", F.coalesce("rating_note", F.lit("none")).alias("rating_note"))


def q_json_array(spark, base):
    """JSON array text decoded; empty, null and malformed text give []."""
    k = F.col("p_partkey")
    text = F.when(k % 7 == 0, F.lit("")).when(k % 7 == 1, F.lit(None).cast("string")).when(k % 7 == 2, F.lit("{bad")).otherwise(
        F.to_json(F.array("p_brand", "p_type")))
    a = read_table(spark, "part", base).select("p_partkey", text.alias("text")).select("p_partkey", decode_json_array(F.col("text")).alias("a"))
    return a.select("p_partkey", F.size("a").alias("n"), F.array_join("a", "|").alias("joined"))


def q_enrich_left(spark, base):
    books = D.readings(spark, base).select("book_id", "username", "title", "read_at")
    starts = start_dates(latest_written(D.review_pages(spark, base)), snapshot=False)
    return enrich_books(books, starts, stamp=False).select(
        "book_id", "username", "title", "read_at", "started_reading")


def q_html_last_labelled(spark, base):
    p = read_table(spark, "pages", base)
    return p.select("page_id", extract_labelled("html", css_class="ad", label="th", sep=".").alias("ad_head"))


def q_page_validity(spark, base):
    return validate_pages(_review_landing(spark, base), key="key", mode="flag").select("book_id", "username", "page_valid")


def _review_landing(spark, base) -> DataFrame:
    """Every wanted review page with what was landed for it: pages that name
    their book, pages that don't (an expired session) and missing pages."""
    wanted = D.readings(spark, base).select("book_id", "username",
                                            F.concat(F.lit("https://example.org/review/show/"), "book_id").alias("goodreads_url"))
    landed = D.review_pages(spark, base).filter(F.col("_ingested_at") == F.lit(D.NEW_BATCH).cast("timestamp"))
    return land_pages(wanted, landed).withColumn("key", F.concat(F.lit("/book/show/"), "book_id", F.lit('"')))


def q_page_quarantine(spark, base):
    _, rejected = validate_pages(_review_landing(spark, base), key="key", mode="quarantine")
    return rejected.select("book_id", "username", F.col("raw_html").isNull().alias("missing"))


def q_page_accepted(spark, base):
    """S7 in fail mode, over the pages that quarantine lets through."""
    good, _ = validate_pages(_review_landing(spark, base), key="key", mode="quarantine")
    return validate_pages(good, key="key", mode="fail").select("book_id", "username")


def q_bib_record(spark, base):
    r = D.bib_json(spark, base).select("p_partkey", parse_bib_record("raw_json").alias("r"))
    return r.select("p_partkey", "r.ol_key", "r.ol_title", joined(F.col("r.subjects")).alias("subjects"),
                    joined(F.col("r.authors")).alias("authors"),
                    joined(F.col("r.publishers")).alias("publishers"),
                    F.size("r.subjects").alias("n_subjects"), "r.publish_date", "r.number_of_pages",
                    "r.cover_url")


# -- classification and genre summary ------------------------------------

def q_keyword_classify(spark, base):
    s = D.part_subjects(spark, base).select("book_id", classify("subjects", PART_RULES).alias("labels"))
    return s.select("book_id", F.array_join("labels", "|").alias("labels"), F.size("labels").alias("n_labels"))


def _genre_parts(spark, base):
    books = G.qualifying_books(D.part_books(spark, base))
    classified = G.classified_subjects(D.part_subjects(spark, base), rules=PART_RULES)
    return books, classified


def _genre_summary(spark, base):
    s = G.genre_summary(*_genre_parts(spark, base), scale=None)
    return s.withColumn("avg_user_rating", rnd(F.col("avg_user_rating"), 2))


def q_genre_summary(spark, base):
    return _genre_summary(spark, base)


def q_genre_unmatched(spark, base):
    u = G.genre_unmatched(*_genre_parts(spark, base))
    return u.select("username", "book_id", joined(F.col("subjects")).alias("subjects"))


def q_genre_coverage(spark, base):
    return G.books_with_genre(*_genre_parts(spark, base))


def q_genre_view(spark, base):
    return M.genre_view(_genre_summary(spark, base))


def q_dense_matrix(spark, base):
    return M.dense_matrix(_genre_summary(spark, base))


def q_metric_long(spark, base):
    return M.metric_long(_genre_summary(spark, base))


def q_metric_pick(spark, base):
    return M.metric_long(_genre_summary(spark, base), pick="total_pages")


# -- lookups --------------------------------------------------------------

def _plan(spark, base, size: int = 20):
    return plan_lookups(lookup_keys(D.lookup_books(spark, base)), size)


def q_lookup_requests(spark, base):
    """As few requests as the keys need, no key lost or doubled."""
    p = _plan(spark, base).select(F.size("members").alias("n"))
    return p.agg(F.count(F.lit(1)).alias("n_requests"), F.sum("n").alias("n_keys"), F.max("n").cast("int").alias("largest"))


def q_lookup_plan(spark, base):
    p = _plan(spark, base)
    m = p.select("api_url", F.size("members").alias("n"), F.explode("members").alias("m"))
    return m.select("m.isbn", "m.book_id", (F.col("n") <= 20).alias("chunk_ok"),
                    F.contains("api_url", F.concat(F.lit("ISBN:"), F.col("m.isbn"))).alias("in_url"))


def _resolved(spark, base, size: int = 20):
    # the plan is a stored table in the stage flow; responses land per chunk
    p = _plan(spark, base, size)
    return resolve_lookups(p, D.landed_responses(p))


def q_lookup_resolve(spark, base):
    r = _resolved(spark, base)
    return r.select("isbn", "book_id", "status", F.get_json_object("raw_json", "$.key").alias("ol_key"),
                    (F.col("api_url") != "").alias("has_url"))


def q_lookup_status(spark, base):
    return lookup_status(_resolved(spark, base, size=1))


def q_lookup_errors(spark, base):
    """Everything not ok; failed and missing responses are planted per
    request, so each key is a request of its own here."""
    return lookup_errors(_resolved(spark, base, size=1)).select("isbn", "book_id", "status", (F.col("api_url") != "").alias("has_url"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "daily_allocation": q_daily_allocation,
    "daily_allocation_sparse": q_daily_allocation_sparse,
    "daily_allocation_dense": q_daily_allocation_dense,
    "daily_ordered": q_daily_ordered,
    "daily_rounded": q_daily_rounded,
    "genre_ordered": q_genre_ordered,
    "date_rejects": q_date_rejects,
    "silver_overwritten": q_silver_overwritten,
    "silver_switched": q_silver_switched,
    "bronze_partitions": q_bronze_partitions,
    "run_metrics": q_run_metrics,
    "bronze_widened": q_bronze_widened,
    "json_array": q_json_array,
    "page_quarantine": q_page_quarantine,
    "page_accepted": q_page_accepted,
    "metric_pick": q_metric_pick,
    "lookup_requests": q_lookup_requests,
    "lookup_errors": q_lookup_errors,
    "shared_boundaries": q_shared_boundaries,
    "skipped_report": q_skipped_report,
    "rolling_mean_7": q_rolling_mean_7,
    "rolling_mean_range": q_rolling_mean_range,
    "daily_view": q_daily_view,
    "labels_joined": q_labels_joined,
    "date_domain": q_date_domain,
    "latest_batch": q_latest_batch,
    "typed_clean": q_typed_clean,
    "date_parse": q_date_parse,
    "feed_scan": q_feed_scan,
    "feed_to_silver": q_feed_to_silver,
    "enrich_left": q_enrich_left,
    "html_last_labelled": q_html_last_labelled,
    "page_validity": q_page_validity,
    "bib_record": q_bib_record,
    "keyword_classify": q_keyword_classify,
    "genre_summary": q_genre_summary,
    "genre_unmatched": q_genre_unmatched,
    "genre_coverage": q_genre_coverage,
    "genre_view": q_genre_view,
    "dense_matrix": q_dense_matrix,
    "metric_long": q_metric_long,
    "lookup_plan": q_lookup_plan,
    "lookup_resolve": q_lookup_resolve,
    "lookup_status": q_lookup_status,
}
