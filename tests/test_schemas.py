"""The declared layer schemas are what the operators produce."""

import datetime as dt

from lectio.functions.bib import parse_bib_record
from lectio.operators.cleaning import clean_books
from lectio.operators.genre import classified_subjects, genre_summary, qualifying_books
from lectio.operators.intervals import pages_per_day
from lectio.schemas import BIB_RECORD, BRONZE_RSS, GOLD_DAILY, GOLD_GENRE, SILVER_BOOKS
from lectio.sources.tables import rows_to_frame


def shape(schema):
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def test_silver_books_schema(spark):
    row = {c.name: "" for c in BRONZE_RSS.fields if c.name not in ("_ingested_at",)}
    row.update(book_id="1", num_pages="12", read_at="March 1, 2026", _source="rss")
    row["_ingested_at"] = dt.datetime(2024, 1, 1)
    bronze = rows_to_frame(spark, [row], BRONZE_RSS)
    assert shape(clean_books(bronze).schema) == shape(SILVER_BOOKS)


def test_gold_schemas(spark):
    books = spark.createDataFrame(
        [("u", "1", "T", dt.date(2024, 1, 1), dt.date(2024, 1, 2), 10, 4, True)],
        "username string, book_id string, title string, started_reading date, read_at date, "
        "num_pages int, user_rating int, is_read boolean")
    assert shape(pages_per_day(books).schema) == shape(GOLD_DAILY)
    rec = spark.createDataFrame([("1", "ok", ["Fantasy"])], "book_id string, status string, subjects array<string>")
    g = genre_summary(qualifying_books(books), classified_subjects(rec))
    assert shape(g.schema) == shape(GOLD_GENRE)
    assert [(r.genre, r.book_count) for r in g.collect()] == [("Fantasy", 1)]


def test_bib_schema(spark):
    df = spark.createDataFrame([("{}",)], "j string").select(parse_bib_record("j").alias("r"))
    assert shape(df.schema["r"].dataType) == shape(BIB_RECORD)
