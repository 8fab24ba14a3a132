"""The bronze -> silver -> gold stages in dependency order, as plain
functions over table folders (parquet). Each stage reads its inputs,
builds one lazy plan and writes once; bronze appends a batch, silver and
gold are replaced, so that a failed stage leaves the last table as it was.
Silver and gold may be paths or catalog names (``db.table``); a name is
switched to the new rows by one catalog operation. With a ``reports`` folder
a stage also writes its row counts (``run_metrics``, under the ``run`` it is
given) and what it left out or could not use: ``date_rejects``, ``rejected_pages``,
``skipped_intervals``, ``lookup_status``, ``lookup_errors``,
``genre_unmatched`` and ``genre_coverage``.

    books_stage -> pages_stage -> daily_stage
    books_stage -> lookup_plan_stage -> (responses landed) -> lookups_stage -> genre_stage
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectio.functions.bib import parse_bib_record
from lectio.operators.batches import stamp_batch
from lectio.operators.cleaning import clean_books, date_rejects
from lectio.operators.enrich import enrich_books, start_dates
from lectio.operators.genre import books_with_genre, classified_subjects, genre_summary, genre_unmatched, qualifying_books
from lectio.operators.intervals import pages_per_day, skipped_intervals
from lectio.operators.lookups import lookup_keys, plan_lookups, resolve_lookups
from lectio.operators.quality import lookup_errors, lookup_status, record_metrics, validate_pages, with_row_count
from lectio.schemas import BRONZE_LOOKUP, BRONZE_PAGES, BRONZE_RSS
from lectio.sources.catalog import is_table_name
from lectio.sources.feed import scan_feed
from lectio.sources.landing import land_pages, wanted_pages
from lectio.sources.sinks import append_bronze, overwrite_table
from lectio.sources.tables import latest_bronze

Stamp = _dt.datetime | str | None


def _report(df: DataFrame, reports: str | None, name: str) -> None:
    """Rows a stage left out, kept as a table next to its output."""
    if reports is not None:
        overwrite_table(df, f"{reports.rstrip('/')}/{name}")


def _counted(df: DataFrame, name: str, metrics: dict):
    """Row count gathered by the write job itself (no extra count job)."""
    df, obs = with_row_count(df, name)
    metrics[name] = obs
    return df


def _values(spark: SparkSession, metrics: dict, stage: str, reports: str | None, run: str) -> dict[str, int]:
    """The counts of the stage's writes; kept next to its reports."""
    rows = {k: v.get["rows"] for k, v in metrics.items()}
    if reports is not None:
        record_metrics(spark, f"{reports.rstrip('/')}/run_metrics", run, stage, rows)
    return rows


def _read(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table) if is_table_name(table) else spark.read.parquet(table)


def books_stage(spark: SparkSession, feeds: list[str], bronze: str, silver: str,
                batch_ts: Stamp = None, reports: str | None = None, run: str = "") -> dict[str, int]:
    """Landed feeds -> bronze_rss (append) -> silver_books (replace).
    Returns the rows written per table."""
    m: dict = {}
    append_bronze(_counted(stamp_batch(scan_feed(spark, feeds), "rss", batch_ts), "bronze_rss", m), bronze)
    newest = latest_bronze(spark, bronze, BRONZE_RSS)
    overwrite_table(_counted(clean_books(newest, snapshot=False), "silver_books", m), silver)
    _report(date_rejects(newest), reports, "date_rejects")
    return _values(spark, m, "books", reports, run)


def pages_stage(spark: SparkSession, silver: str, landed: DataFrame, bronze: str, enriched: str,
                mode: str = "fail", batch_ts: Stamp = None,
                metrics: dict[str, int] | None = None, reports: str | None = None, run: str = "") -> DataFrame | None:
    """Landed pages for wanted URLs -> validated -> bronze_review_pages
    (append) -> start dates -> silver_books_enriched (replace). In
    ``quarantine`` mode the rejected pages are returned. Rows written per
    table are put into ``metrics`` when given."""
    m: dict = {}
    books = _read(spark, silver)
    pages = land_pages(wanted_pages(books), landed)
    rejected = None
    if mode == "quarantine":
        pages, rejected = validate_pages(pages, mode="quarantine")
        _report(rejected, reports, "rejected_pages")
    else:
        pages = validate_pages(pages, mode="fail")
    append_bronze(_counted(stamp_batch(pages, "review_page", batch_ts), "bronze_review_pages", m), bronze)
    starts = start_dates(latest_bronze(spark, bronze, BRONZE_PAGES), snapshot=False)
    overwrite_table(_counted(enrich_books(books, starts), "silver_books_enriched", m), enriched)
    rows = _values(spark, m, "pages", reports, run)
    if metrics is not None:
        metrics.update(rows)
    return rejected


def daily_stage(spark: SparkSession, enriched: str, gold: str, reports: str | None = None, run: str = "") -> dict[str, int]:
    """silver_books_enriched -> gold_pages_per_day (replace)."""
    m: dict = {}
    books = _read(spark, enriched)
    overwrite_table(_counted(pages_per_day(books), "gold_pages_per_day", m), gold, sort_within=("username", "date"))
    _report(skipped_intervals(books), reports, "skipped_intervals")
    return _values(spark, m, "daily", reports, run)


def lookup_plan_stage(spark: SparkSession, silver: str, plan: str, size: int = 20) -> None:
    """silver_books -> request plan (chunks of <= size keys, one URL each)
    for the fetcher that lands responses keyed by chunk_id."""
    overwrite_table(plan_lookups(lookup_keys(_read(spark, silver)), size), plan)


def lookups_stage(spark: SparkSession, plan: str, responses: DataFrame, bronze: str, silver_ol: str,
                  batch_ts: Stamp = None, reports: str | None = None, run: str = "") -> dict[str, int]:
    """Plan + landed responses -> bronze_open_library (append) ->
    silver_open_library (newest batch, parsed; replace)."""
    m: dict = {}
    resolved = resolve_lookups(_read(spark, plan), responses)
    append_bronze(_counted(stamp_batch(resolved, "open_library", batch_ts), "bronze_open_library", m), bronze)
    snap = latest_bronze(spark, bronze, BRONZE_LOOKUP)
    parsed = snap.select("isbn", "book_id", "status", parse_bib_record("raw_json").alias("_p"))
    out = parsed.select("isbn", "book_id", "status", "_p.*", F.current_timestamp().alias("_parsed_at"))
    overwrite_table(_counted(out, "silver_open_library", m), silver_ol)
    _report(lookup_status(snap), reports, "lookup_status")
    _report(lookup_errors(snap).drop("raw_json"), reports, "lookup_errors")
    return _values(spark, m, "lookups", reports, run)


def genre_stage(spark: SparkSession, silver: str, silver_ol: str, gold: str, reports: str | None = None, run: str = "") -> dict[str, int]:
    """silver_books + silver_open_library -> gold_genre (replace)."""
    m: dict = {}
    books = qualifying_books(_read(spark, silver))
    records = classified_subjects(_read(spark, silver_ol))
    overwrite_table(_counted(genre_summary(books, records), "gold_genre", m), gold,
                    sort_within=("username", "genre"))
    _report(genre_unmatched(books, records), reports, "genre_unmatched")
    _report(books_with_genre(books, records), reports, "genre_coverage")
    return _values(spark, m, "genre", reports, run)
