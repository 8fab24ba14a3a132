"""Page landing (S6): which wanted pages are landed, with their HTML."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectio.operators.quality import non_empty


def wanted_pages(silver_books: DataFrame) -> DataFrame:
    """(book_id, goodreads_url, username) for every non-empty URL."""
    return (silver_books.select("book_id", "goodreads_url", "username")
            .filter(non_empty("goodreads_url")))


def land_pages(wanted: DataFrame, landed: DataFrame, url: str = "goodreads_url",
               html: str = "raw_html") -> DataFrame:
    """Wanted pages joined to landed HTML by URL (left: missing pages keep
    a NULL page so they show up in validation instead of vanishing)."""
    pages = landed.select(F.col(url).alias("_url"), F.col(html).alias("raw_html"))
    return (wanted.join(pages, wanted[url] == F.col("_url"), "left").drop("_url")
            .select("book_id", url, "username", "raw_html"))


def read_landed_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed pages -> (goodreads_url, raw_html): JSON lines, one fetched
    page per line (the HTML escaped as a JSON string), split by Spark
    across tasks like any line-delimited file."""
    return spark.read.schema("goodreads_url string, raw_html string").json(path)


def read_landed_responses(spark: SparkSession, path: str) -> DataFrame:
    """Landed lookup responses -> (chunk_id, body, error): JSON lines, one
    per planned chunk, ``body`` the response text or ``error`` a message."""
    return spark.read.schema("chunk_id string, body string, error string").json(path)
