"""X4, J1 dedupe, O1 idempotent batch append, ordered views."""

import datetime as dt
import os

from pyspark.sql import functions as F

from lectio.functions.text import decode_json_array, quote_url
from lectio.operators.batches import stamp_batch
from lectio.operators.enrich import enrich_books
from lectio.operators.metrics import daily_view
from lectio.sources.sinks import append_bronze
from lectio.sources.tables import read_bronze


def test_decode_json_array(spark):
    df = spark.createDataFrame([('["a","b"]',), ("",), (None,), ("[]",)], "j string")
    assert [r.a for r in df.select(decode_json_array(F.col("j")).alias("a")).collect()] == [["a", "b"], [], [], []]


def test_quote_url(spark):
    df = spark.createDataFrame([("ISBN:1,ISBN:2 x/y*~",)], "s string")
    assert df.select(quote_url(F.col("s")).alias("u")).first().u == "ISBN:1,ISBN:2%20x/y%2A~"


def test_enrich_faithful_fanout_and_dedupe(spark):
    books = spark.createDataFrame([("1", "u", "A"), ("1", "u", "A")], "book_id string, username string, title string")
    starts = spark.createDataFrame([("1", "u", dt.date(2024, 1, 1)), ("1", "u", dt.date(2024, 1, 5))],
                                   "book_id string, username string, started_reading date")
    assert enrich_books(books, starts, stamp=False).count() == 4
    d = enrich_books(books, starts, dedupe=True, stamp=False).collect()
    assert len(d) == 2 and {r.started_reading for r in d} == {dt.date(2024, 1, 5)}
    assert enrich_books(books, starts).columns[:2] == ["book_id", "username"]


def test_bronze_retry_is_idempotent(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "bronze")
    b = stamp_batch(spark.createDataFrame([("1",), ("2",)], "book_id string"), "rss", "2024-01-01 00:00:00")
    append_bronze(b, path)
    append_bronze(b, path)  # retried batch
    append_bronze(stamp_batch(spark.createDataFrame([("3",)], "book_id string"), "rss", "2024-01-02 00:00:00"), path)
    assert sorted(r.book_id for r in read_bronze(spark, path).collect()) == ["1", "2", "3"]


def test_ordered_view(spark):
    g = spark.createDataFrame([("b", dt.date(2024, 1, 2), 1.0, ["x"]), ("a", dt.date(2024, 1, 3), 2.0, []),
                               ("a", dt.date(2024, 1, 1), 3.0, ["y", "z"])],
                              "username string, date date, est_pages_read double, books_in_progress array<string>")
    r = daily_view(g, ordered=True).collect()
    assert [(x.username, x.date.day, x.books_in_progress) for x in r] == [("a", 1, 2), ("a", 3, 0), ("b", 2, 1)]


def test_date_rejects_and_union_feeds(spark):
    from lectio.operators.cleaning import date_rejects
    from lectio.sources.feed import union_feeds

    df = spark.createDataFrame([("March 1, 2026", "garbage"), ("", "garbage"), ("soon", None)],
                               "read_at string, date_added string")
    r = {(x.column, x.text): x.n for x in date_rejects(df).collect()}
    assert r == {("date_added", "garbage"): 2, ("read_at", "soon"): 1}
    a = spark.createDataFrame([("1",)], "book_id string")
    b = spark.createDataFrame([("2", "x")], "book_id string, extra string")
    u = union_feeds(a, b)
    assert u.columns == ["book_id", "extra"] and u.count() == 2


def test_pages_stage_quarantine(spark, tmpdir_path):
    from lectio.plans import stages

    p = lambda n: os.path.join(tmpdir_path, n)
    silver = spark.createDataFrame([("1", "u1", "ann"), ("2", "u2", "ann"), ("3", "", "ann")],
                                   "book_id string, goodreads_url string, username string")
    silver.write.parquet(p("silver"))
    landed = spark.createDataFrame([("u1", "<p>1</p><div class='readingTimeline__text'>May 1, 2025 – Started Reading</div>"),
                                    ("u2", "<p>login</p>")], "goodreads_url string, raw_html string")
    rejected = stages.pages_stage(spark, p("silver"), landed, p("bronze_pages"), p("enriched"), mode="quarantine",
                                  batch_ts="2026-01-01 00:00:00")
    assert [r.book_id for r in rejected.collect()] == ["2"]
    e = {r.book_id: r.started_reading for r in spark.read.parquet(p("enriched")).collect()}
    assert e == {"1": dt.date(2025, 5, 1), "2": None, "3": None}


def test_read_landed_files(spark, tmpdir_path):
    import json

    from lectio.sources.landing import read_landed_pages, read_landed_responses

    pages = os.path.join(tmpdir_path, "pages.jsonl")
    urls = {"https://example.org/review/show/1": "<html>1\n<div class='readingTimeline__text'>x</div></html>",
            "https://example.org/review/show/2?x=1": "<html>2 \"q\" ü</html>"}
    with open(pages, "w") as f:
        for u, h in urls.items():
            f.write(json.dumps({"goodreads_url": u, "raw_html": h}) + "\n")
    got = {r.goodreads_url: r.raw_html for r in read_landed_pages(spark, pages).collect()}
    assert got == urls
    resp = os.path.join(tmpdir_path, "resp.jsonl")
    with open(resp, "w") as f:
        f.write(json.dumps({"chunk_id": "0-0", "body": '{"ISBN:1": {}}'}) + "\n")
        f.write(json.dumps({"chunk_id": "0-1", "error": "HTTP 500"}) + "\n")
    r = {x.chunk_id: (x.body, x.error) for x in read_landed_responses(spark, resp).collect()}
    assert r == {"0-0": ('{"ISBN:1": {}}', None), "0-1": (None, "HTTP 500")}


def test_register_table(spark, tmpdir_path):
    from lectio.sources.catalog import register_table
    from lectio.sources.sinks import overwrite_table

    path = os.path.join(tmpdir_path, "gold")
    overwrite_table(spark.createDataFrame([("a", 1)], "username string, n int"), path)
    register_table(spark, "lectio_reg_db.gold_t", path)
    assert spark.table("lectio_reg_db.gold_t").count() == 1
    overwrite_table(spark.createDataFrame([("a", 1), ("b", 2)], "username string, n int"), path)
    register_table(spark, "lectio_reg_db.gold_t", path)
    assert spark.table("lectio_reg_db.gold_t").count() == 2
