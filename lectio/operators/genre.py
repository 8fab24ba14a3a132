"""Per user per genre summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectio.operators.classify import GENRE_RULES, Rule, classify
from lectio.operators.quality import positive


def qualifying_books(silver_books: DataFrame) -> DataFrame:
    """Read books with a rating and a page count."""
    keep = F.col("is_read") & positive("user_rating") & positive("num_pages")
    return silver_books.where(keep).select("username", "book_id", "user_rating", "num_pages")


def classified_subjects(records: DataFrame, key: str = "book_id", subjects: str = "subjects",
                        rules: list[Rule] = GENRE_RULES, ok_only: bool = True) -> DataFrame:
    """Classify each record ONCE, before joining it to the (larger) book
    side, so the classifier runs per record, not per user-book."""
    if ok_only and "status" in records.columns:
        records = records.filter(F.col("status") == "ok")
    return records.select(key, subjects, classify(subjects, rules).alias("genres"))


def by_first_genre(classified: DataFrame, *cols: str) -> DataFrame:
    """(cols..., genre): the first genre of each record, null for none.

    A generator's output, on purpose: a filter on ``genres`` itself would be
    pushed below the classifier's projection, where each of its string tests
    evaluates the normalisation again."""
    return classified.select(*cols, F.explode_outer(F.slice("genres", 1, 1)).alias("genre"))


def genre_summary(books: DataFrame, classified: DataFrame, key: str = "book_id",
                  user: str = "username", rating: str = "user_rating",
                  pages: str = "num_pages", scale: int | None = 2) -> DataFrame:
    """(user, genre, avg_user_rating, total_pages int, book_count int).

    Each record's labels are exploded once on the record side, then the
    books join the (key, genre) pairs: a book with several records counts
    once per record and genre, as in the source. One aggregation with
    map-side partial aggregation follows. AQE decides broadcast vs shuffle
    from measured sizes; nothing is broadcast unconditionally. Empty lists
    go after the generator (an inner ``explode`` infers a filter on the
    list's size and pushes the classifier into it, once per test).
    ``scale=None`` leaves the average unrounded."""
    pairs = classified.select(key, F.explode_outer("genres").alias("genre")).where(F.col("genre").isNotNull())
    mean = F.avg(rating)
    j = books.select(key, user, rating, pages).join(pairs, key, "inner")
    return (j.groupBy(user, "genre")
            .agg((mean if scale is None else F.round(mean, scale)).alias("avg_user_rating"),
                 F.sum(pages).cast("int").alias("total_pages"),
                 F.count(F.lit(1)).cast("int").alias("book_count")))


def genre_unmatched(books: DataFrame, classified: DataFrame, key: str = "book_id",
                    user: str = "username") -> DataFrame:
    """K3: (user, key, subjects) of joined books with no genre."""
    none = by_first_genre(classified, key, "subjects").where(F.col("genre").isNull())
    return books.join(none, key, "inner").select(user, key, "subjects")


def books_with_genre(books: DataFrame, classified: DataFrame, key: str = "book_id") -> DataFrame:
    """A10: number of distinct books mapped to at least one genre."""
    some = by_first_genre(classified, key).where(F.col("genre").isNotNull())
    return books.join(some, key, "inner").agg(F.count_distinct(key).alias("books_with_genre"))
