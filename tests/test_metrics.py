"""W1, F10, D1-D6."""

import datetime as dt

from lectio.operators.metrics import (
    daily_view, date_domain, date_range, dense_matrix, genre_view, metric_long, rolling_mean, title_labels,
)

D = dt.date


def gold(spark):
    rows = [("a", D(2024, 1, d), float(d), ["x"] * (d % 3)) for d in range(1, 11)]
    rows += [("b", D(2024, 1, d), 2.0 * d, []) for d in range(3, 8)]
    return spark.createDataFrame(rows, "username string, date date, est_pages_read double, "
                                       "books_in_progress array<string>")


def test_rolling_mean_identity_and_range(spark):
    g = gold(spark)
    r1 = rolling_mean(g, 1).collect()
    assert all(r.rolling_mean == r.est_pages_read for r in r1)
    r = {(x.username, x.date.day): x.rolling_mean
         for x in rolling_mean(date_range(g, "2024-01-05", "2024-01-08"), 3).collect()}
    assert r[("a", 5)] == 5.0 and r[("a", 6)] == 5.5 and r[("a", 8)] == 7.0
    assert r[("b", 5)] == 10.0 and ("a", 4) not in r and ("a", 9) not in r


def test_views(spark):
    v = title_labels(daily_view(gold(spark))).filter("username = 'a' and date = '2024-01-02'").first()
    assert v.books_in_progress == 2 and v.book_titles == ["x", "x"] and v.titles_label == "• x<br>• x"
    dd = date_domain(gold(spark)).first()
    assert (dd.min_date, dd.max_date) == (D(2024, 1, 1), D(2024, 1, 10))


def test_dense_and_long(spark):
    s = spark.createDataFrame([("a", "Fantasy", 4.0, 300, 2), ("b", "Romance", 3.5, 100, 1)],
                              "username string, genre string, avg_user_rating double, total_pages int, book_count int")
    d = {(r.username, r.genre): (r.avg_user_rating, r.total_pages, r.book_count)
         for r in dense_matrix(genre_view(s)).collect()}
    assert d == {("a", "Fantasy"): (4.0, 300, 2), ("a", "Romance"): (0.0, 0, 0),
                 ("b", "Fantasy"): (0.0, 0, 0), ("b", "Romance"): (3.5, 100, 1)}
    three = spark.createDataFrame([("a", "Fantasy", 4.0, 300, 2), ("a", "Poetry", 2.0, 10, 1), ("b", "Fantasy", 3.0, 5, 1)], s.schema)
    rows = {(r.username, r.genre): r.total_pages for r in dense_matrix(three).collect()}  # a genre no rule names stays
    assert rows == {("a", "Fantasy"): 300, ("a", "Poetry"): 10, ("b", "Fantasy"): 5, ("b", "Poetry"): 0}
    long = metric_long(s, pick="total_pages").collect()
    assert sorted((r.username, r.value) for r in long) == [("a", 300.0), ("b", 100.0)]
    assert metric_long(s).count() == 6
