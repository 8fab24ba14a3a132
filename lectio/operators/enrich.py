"""Start dates from landed review pages joined onto books (X2 + X1, J1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectio.functions.dates import parse_flexible_date
from lectio.functions.html import extract_labelled
from lectio.operators.batches import latest_batch


def start_dates(pages: DataFrame, html: str = "raw_html", keys: tuple[str, ...] = ("book_id", "username"),
                snapshot: bool = True, label: str = "Started Reading") -> DataFrame:
    """(keys..., started_reading) from the newest page batch. The HTML is
    reduced to a date before anything shuffles, so the raw pages never
    cross the network."""
    df = latest_batch(pages) if snapshot else pages
    # Two projections: the extracted text is computed once per page and
    # the date layouts then read a column (see parse_flexible_date).
    raw = df.select(*keys, extract_labelled(html, label=label).alias("_started_raw"))
    return raw.select(*keys, parse_flexible_date("_started_raw").alias("started_reading"))


def enrich_books(books: DataFrame, starts: DataFrame, keys: tuple[str, ...] = ("book_id", "username"),
                 dedupe: bool = False, stamp: bool = True) -> DataFrame:
    """Left join on the keys (USING, keys first). Faithful by default:
    k duplicate books with k pages give k*k rows; ``dedupe=True`` keeps one
    start date per key first (the latest, deterministic)."""
    if dedupe:
        starts = starts.groupBy(*keys).agg(F.max("started_reading").alias("started_reading"))
    out = books.join(starts, list(keys), "left")
    return out.withColumn("_enriched_at", F.current_timestamp()) if stamp else out
