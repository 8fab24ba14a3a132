"""Request planning and response fan-out."""

from pyspark.sql import functions as F

from lectio.operators.lookups import lookup_keys, plan_lookups, resolve_lookups
from lectio.operators.quality import lookup_errors, lookup_status


def keys(spark, n):
    rows = [(f"{i:010d}", str(i)) for i in range(n)] + [("", "x"), (None, "y"), ("0000000001", "1")]
    return lookup_keys(spark.createDataFrame(rows, "isbn string, book_id string"))


def test_plan_chunks_bounded_nothing_lost(spark):
    p = plan_lookups(keys(spark, 103), size=20, buckets=4)
    sizes = [r.n for r in p.select(F.size("members").alias("n")).collect()]
    assert max(sizes) <= 20 and sum(sizes) == 103
    members = p.select(F.explode("members").alias("m")).select("m.isbn").collect()
    assert len({m.isbn for m in members}) == 103
    url = p.first().api_url
    assert url.startswith("https://openlibrary.org/api/books?bibkeys=ISBN:") and "%" not in url.split("&")[0]


def test_resolve_statuses(spark):
    p = plan_lookups(keys(spark, 30), size=10, buckets=1)
    chunks = sorted(r.chunk_id for r in p.select("chunk_id").collect())
    assert len(chunks) == 3
    body = '{"ISBN:0000000000": {"key": "/books/OL0M", "title": "Zero"}, "ISBN:0000000003": {"key": "k3"}}'
    resp = spark.createDataFrame([(chunks[0], body, None), (chunks[1], None, "HTTP 500")],
                                 "chunk_id string, body string, error string")
    r = {x.isbn: x for x in resolve_lookups(p, resp).collect()}
    assert len(r) == 30
    assert r["0000000000"].status == "ok" and '"Zero"' in r["0000000000"].raw_json
    assert r["0000000001"].status == "not_found" and r["0000000001"].raw_json is None
    err = [x for x in r.values() if x.status.startswith("error")]
    assert len(err) == 20 and all(x.api_url == "" and x.raw_json is None for x in err)
    assert {x.status for x in err} == {"error: HTTP 500", "error: no response landed"}
    counts = {x.status_class: x.n for x in lookup_status(resolve_lookups(p, resp)).collect()}
    assert counts == {"ok": 2, "not_found": 8, "error": 20}
    assert lookup_errors(resolve_lookups(p, resp)).count() == 28


def test_requests_do_not_depend_on_session_settings(spark):
    k = spark.range(1800).select(F.format_string("%010d", "id").alias("isbn"), F.col("id").cast("string").alias("book_id"))
    assert plan_lookups(k).count() == 90
    many = spark.range(100_000).select(F.format_string("%010d", "id").alias("isbn"), F.col("id").cast("string").alias("book_id"))
    assert 5000 <= plan_lookups(many).count() <= 5003


def test_plan_properties_random(spark):
    import random
    import urllib.parse

    rnd = random.Random(41)
    for size, buckets, n in [(20, 3, 257), (7, 1, 50), (1, 4, 9), (20, 16, 5)]:
        keys = {(f"{rnd.randrange(10**9):010d}", str(rnd.randrange(100))) for _ in range(n)}
        df = spark.createDataFrame(sorted(keys), "isbn string, book_id string")
        plan = plan_lookups(df, size=size, buckets=buckets).collect()
        seen = []
        for chunk in plan:
            members = [(m.isbn, m.book_id) for m in chunk.members]
            assert 1 <= len(members) <= size
            bibkeys = urllib.parse.unquote(chunk.api_url.split("bibkeys=")[1].split("&")[0])
            assert bibkeys.split(",") == [f"ISBN:{i}" for i, _ in members]
            seen.extend(members)
        assert sorted(seen) == sorted(keys)
        assert len({c.chunk_id for c in plan}) == len(plan)
