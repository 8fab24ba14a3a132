"""Declared schemas of every table in the bronze/silver/gold layers.
Nothing is inferred: files are read and rows are built against these."""

from pyspark.sql.types import (
    ArrayType, BooleanType, DateType, DoubleType, IntegerType, StringType,
    StructField, StructType, TimestampType,
)

S = StringType()

# Feed item element path -> bronze column, in feed order.
# `book/num_pages` is the one nested element and the one field not trimmed.
FEED_FIELDS = [
    ("title", "title"),
    ("author_name", "author"),
    ("isbn", "isbn"),
    ("book_id", "book_id"),
    ("book/num_pages", "num_pages"),
    ("book_published", "year_published"),
    ("average_rating", "average_rating"),
    ("user_rating", "user_rating"),
    ("user_read_at", "read_at"),
    ("user_date_added", "date_added"),
    ("user_shelves", "shelves"),
    ("user_review", "review"),
    ("book_description", "book_description"),
    ("book_medium_image_url", "cover_url"),
    ("link", "goodreads_url"),
    ("user_name", "username"),
]

FEED_COLUMNS = [c for _, c in FEED_FIELDS]

# XML read schema for one <item>: flat string elements plus the nested book.
FEED_XML = StructType(
    [StructField(tag, S, True) for tag, _ in FEED_FIELDS if "/" not in tag]
    + [StructField("book", StructType([StructField("num_pages", S, True)]), True)]
)

BRONZE_META = [StructField("_ingested_at", TimestampType(), True),
               StructField("_source", S, True)]

BRONZE_RSS = StructType([StructField(c, S, True) for c in FEED_COLUMNS] + BRONZE_META)

SILVER_BOOKS = StructType([
    StructField("title", S), StructField("author", S), StructField("isbn", S),
    StructField("book_id", S), StructField("num_pages", IntegerType()),
    StructField("year_published", IntegerType()), StructField("average_rating", DoubleType()),
    StructField("user_rating", IntegerType()), StructField("read_at", DateType()),
    StructField("date_added", DateType()), StructField("shelves", S),
    StructField("cover_url", S), StructField("goodreads_url", S), StructField("username", S),
    StructField("_ingested_at", TimestampType()), StructField("is_read", BooleanType()),
])

BRONZE_PAGES = StructType([
    StructField("book_id", S), StructField("goodreads_url", S),
    StructField("username", S), StructField("raw_html", S),
] + BRONZE_META)

BRONZE_LOOKUP = StructType([
    StructField("isbn", S), StructField("book_id", S), StructField("api_url", S),
    StructField("raw_json", S), StructField("status", S),
] + BRONZE_META)

BIB_RECORD = StructType([
    StructField("ol_key", S), StructField("ol_title", S),
    StructField("subjects", ArrayType(S)), StructField("authors", ArrayType(S)),
    StructField("publishers", ArrayType(S)), StructField("publish_date", S),
    StructField("number_of_pages", IntegerType()), StructField("cover_url", S),
])

GOLD_DAILY = StructType([
    StructField("username", S), StructField("date", DateType()),
    StructField("est_pages_read", DoubleType()),
    StructField("books_in_progress", ArrayType(S)),
])

GOLD_GENRE = StructType([
    StructField("username", S), StructField("genre", S),
    StructField("avg_user_rating", DoubleType()), StructField("total_pages", IntegerType()),
    StructField("book_count", IntegerType()),
])
