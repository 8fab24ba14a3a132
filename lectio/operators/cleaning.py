"""Bronze strings -> typed silver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectio.functions.dates import parse_flexible_date
from lectio.operators.batches import latest_batch
from lectio.operators.quality import non_empty


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Tolerant casts; text that is not a value becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def parse_dates(df: DataFrame, cols: list[str]) -> DataFrame:
    """X1 on several columns."""
    return df.withColumns({c: parse_flexible_date(c) for c in cols})


# Silver column types of the feed, and the free-text drop list.
BOOK_TYPES = {"num_pages": "int", "year_published": "int",
              "average_rating": "double", "user_rating": "int"}
BOOK_DATES = ["read_at", "date_added"]
FREE_TEXT = ["book_description", "review"]


def clean_books(bronze: DataFrame, snapshot: bool = True, keep_empty: bool = False) -> DataFrame:
    """silver_books: newest feed batch, rows with a book id, typed fields,
    parsed dates, ``is_read`` from the *parsed* finish date, free text and
    ``_source`` dropped. ``keep_empty`` leaves rows without a book id in."""
    df = latest_batch(bronze) if snapshot else bronze
    df = (df if keep_empty else df.filter(non_empty("book_id"))).drop("_source")
    df = parse_dates(cast_columns(df, BOOK_TYPES), BOOK_DATES)
    return df.withColumn("is_read", F.col("read_at").isNotNull()).drop(*FREE_TEXT)


def date_rejects(bronze: DataFrame, cols: list[str] = BOOK_DATES) -> DataFrame:
    """Non-empty date text no layout could parse: (column, text, n). One
    scan; each distinct text is parsed once, as a generator's output, which
    the filter on it can't be pushed below."""
    texts = bronze.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("text")) for c in cols))).alias("t"))
    counted = texts.select("t.column", "t.text").where(non_empty("text")).groupBy("column", "text").agg(F.count(F.lit(1)).alias("n"))
    parsed = counted.select("column", "text", "n", F.explode(F.array(parse_flexible_date("text"))).alias("_date"))
    return parsed.where(F.col("_date").isNull()).drop("_date")
