"""Reading-domain frames derived from the driver's TPC-H-style tables.

The reference's inputs (feeds, review pages, lookup responses) are not in
the test data, so each is derived from the given tables by Spark itself;
every rule below is a plain function of the source keys, which the SQL
oracles restate. ``k`` is the source row's key (``o_orderkey`` /
``p_partkey``).

Fixed values (the moduli that plant NULLs, junk, duplicates and edge
cases) are gathered here so tests, oracles and docs name one source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectio.sources.tables import read_table

# Readings (orders x customer).
MISSING_START, MISSING_START_R = 97, 3
MISSING_END, MISSING_END_R = 89, 5
MISSING_PAGES, MISSING_PAGES_R = 83, 11
ZERO_PAGES, ZERO_PAGES_R = 79, 13
INVERTED, INVERTED_R = 101, 17
SPAN_MOD = 14          # read_at = start + k % 14 days
PAGES_BASE, PAGES_MOD = 50, 400

# Review pages.
PAGE_MISSING = 11       # no page landed for k % 11 == 0
PAGE_EXPIRED = 23       # k % 23 == 0: the page does not name its book
PAGE_REREAD = 5         # earlier read 400 days before for k % 5 == 0
PAGE_VARIANT = 7        # k % 7: 0 hyphen (no match), 1 &ndash;, 2 inner tags, 3 class list, 4 no start row, 5 nested divs, 6 broken
PAGE_DEPTH = 40         # nested divs: k % 40 + 1 deep
PAGE_BROKEN = 3         # k % 3 of the broken ones: 0 unclosed inside a section, 1 page cut off within the next tag
PAGE_SHORT_MONTH = 3    # k % 3 == 0 writes "Mar 29, 2026"
PAGE_OLD_BATCH = 4      # k % 4 == 0 also in an older batch with a wrong date

# Feed rows.
FEED_NO_ISBN = 10
FEED_NO_ID = 37
FEED_UNREAD = 9
FEED_BAD_DATE = 41
FEED_ONLY_OLD = 13
FEED_IN_OLD = 4
OLD_BATCH = "2024-01-01 06:00:00"
NEW_BATCH = "2024-01-02 06:00:00"

# Bibliographic records (part).
BIB_MALFORMED = 17
BIB_MIXED = 3
BIB_NO_PUBLISHERS = 4


def _k(name: str) -> Column:
    return F.col(name)


def _date(c: Column | str) -> Column:
    return F.to_date(F.col(c) if isinstance(c, str) else c)


def readings(spark: SparkSession, base: str, user: str = "customer", keep_source: bool = False) -> DataFrame:
    """(username, book_id, title, started_reading, read_at, num_pages).

    username = nation (``userNN``) or customer name; planted: NULL start,
    NULL finish, NULL / zero pages, inverted intervals."""
    o = read_table(spark, "orders", base).select("o_orderkey", "o_custkey", "o_orderdate")
    c = read_table(spark, "customer", base).select("c_custkey", "c_nationkey", "c_name")
    j = o.join(c, o.o_custkey == c.c_custkey)
    k = _k("o_orderkey")
    day = _date("o_orderdate")
    span = (k % SPAN_MOD).cast("int")
    uname = (F.format_string("user%02d", "c_nationkey") if user == "nation" else F.col("c_name"))
    return j.select(
        uname.alias("username"),
        k.cast("string").alias("book_id"),
        k.cast("string").alias("title"),
        F.when(k % MISSING_START == MISSING_START_R, F.lit(None).cast("date"))
         .otherwise(day).alias("started_reading"),
        F.when(k % MISSING_END == MISSING_END_R, F.lit(None).cast("date"))
         .when(k % INVERTED == INVERTED_R, F.date_sub(day, 2))
         .otherwise(F.date_add(day, span)).alias("read_at"),
        F.when(k % MISSING_PAGES == MISSING_PAGES_R, F.lit(None).cast("int"))
         .when(k % ZERO_PAGES == ZERO_PAGES_R, F.lit(0))
         .otherwise((k % PAGES_MOD + PAGES_BASE).cast("int")).alias("num_pages"),
        *([k.alias("_k"), day.alias("_day")] if keep_source else []),
    )


def _timeline_row(text: Column, cls: str = "readingTimeline__text") -> Column:
    return F.concat(F.lit(f'<div class="{cls}">'), text, F.lit("</div>"))


def _in_batches(df: DataFrame, conds: list[Column]) -> DataFrame:
    """One scan, several batches: each source row is repeated once per
    batch it belongs to, tagged ``_bi`` (index into ``conds``). Batch
    columns are computed after the explode from ``_bi``, so a consumer that
    needs only the stamp (the newest-batch max) never builds the text."""
    idx = F.filter(F.array(*[F.when(c, F.lit(i)) for i, c in enumerate(conds)]), lambda x: x.isNotNull())
    return df.select("*", F.explode(idx).alias("_bi"))


def _pick(values: list[Column]) -> Column:
    """Value of the row's batch (see _in_batches)."""
    out = values[-1]
    for i in range(len(values) - 2, -1, -1):
        out = F.when(F.col("_bi") == i, values[i]).otherwise(out)
    return out


def review_pages(spark: SparkSession, base: str) -> DataFrame:
    """Landed review pages: (book_id, goodreads_url, username, raw_html,
    _ingested_at, _source), two batches from one scan; see PAGE_*."""
    r = readings(spark, base, keep_source=True)
    k = F.col("_k")
    start = F.col("_day")
    fmt = lambda d: F.when(k % PAGE_SHORT_MONTH == 0, F.date_format(d, "MMM d, yyyy")) \
        .otherwise(F.date_format(d, "MMMM d, yyyy"))
    v = k % PAGE_VARIANT
    depth = (k % PAGE_DEPTH + 1).cast("int")
    open_row = F.concat(F.lit('<div class="readingTimeline__text">'), fmt(start), F.lit(" – Started Reading"))
    start_row = (
        F.when(v == 0, _timeline_row(F.concat(fmt(start), F.lit(" - Started Reading"))))
        .when(v == 1, _timeline_row(F.concat(fmt(start), F.lit(" &ndash; Started Reading"))))
        .when(v == 2, _timeline_row(F.concat(F.lit("<span>"), fmt(start),
                                             F.lit("</span> – <b>Started Reading</b>"))))
        .when(v == 3, _timeline_row(F.concat(fmt(start), F.lit(" – Started Reading")),
                                    "x readingTimeline__text"))
        .when(v == 4, F.lit(""))
        .when(v == 5, F.concat(F.lit('<div title="a>b" class="readingTimeline__text">'), F.repeat(F.lit("<div>"), depth), fmt(start),
                               F.repeat(F.lit("</div>"), depth), F.lit(" <div>&#X2013; Started Reading</div></div>")))
        .when((v == 6) & (k % PAGE_BROKEN == 0), F.concat(F.lit("<section>"), open_row, F.lit("</section>")))
        .otherwise(_timeline_row(F.concat(fmt(start), F.lit(" – Started Reading")))))
    earlier = F.when(k % PAGE_REREAD == 0, F.concat(
        _timeline_row(F.concat(fmt(F.date_sub(start, 400)), F.lit(" – Started Reading"))),
        _timeline_row(F.concat(fmt(F.date_sub(start, 390)), F.lit(" – Finished Reading"))),
    )).otherwise(F.lit(""))
    finish_row = _timeline_row(F.concat(F.coalesce(fmt(F.col("read_at")), F.lit("")),
                                        F.lit(" – Finished Reading")))
    link = F.when(k % PAGE_EXPIRED == 0, F.lit("/sign_in")).otherwise(F.concat(F.lit("/book/show/"), F.col("book_id")))
    top = F.concat(F.lit('<html><body><a href="'), link, F.lit('">book</a><div class="readingTimeline">'), earlier)
    html = F.when((v == 6) & (k % PAGE_BROKEN == 1), F.concat(top, open_row, F.lit('<div class="reading'))).otherwise(
        F.concat(top, start_row, finish_row, F.lit("</div></body></html>")))
    old_html = F.concat(F.lit('<html><body><div class="readingTimeline__text">'),
                        fmt(F.date_add(start, 100)), F.lit(" – Started Reading</div></body></html>"))
    url = F.concat(F.lit("https://example.org/review/show/"), F.col("book_id"))
    b = _in_batches(r, [k % PAGE_MISSING != 0, k % PAGE_OLD_BATCH == 0])
    return b.select(
        "book_id", url.alias("goodreads_url"), "username", _pick([html, old_html]).alias("raw_html"),
        _pick([F.lit(NEW_BATCH), F.lit(OLD_BATCH)]).cast("timestamp").alias("_ingested_at"),
        F.lit("review_page").alias("_source"))


def feed_rows(spark: SparkSession, base: str) -> DataFrame:
    """bronze_rss-shaped string rows in two batches; see the FEED_* rules."""
    o = read_table(spark, "orders", base).select("o_orderkey", "o_custkey", "o_orderdate")
    c = read_table(spark, "customer", base).select("c_custkey", "c_name")
    j = o.join(c, o.o_custkey == c.c_custkey)
    k = _k("o_orderkey")
    ks = k.cast("string")
    day = _date("o_orderdate")
    finish = F.date_add(day, (k % SPAN_MOD).cast("int"))
    pages = (k % PAGES_MOD + PAGES_BASE).cast("string")
    m6 = k % 6
    cols = {
        "title": F.concat(F.lit("Book "), ks),
        "author": F.col("c_name"),
        "isbn": F.when(k % FEED_NO_ISBN == 0, F.lit("")).otherwise(F.lpad(ks, 10, "0")),
        "book_id": F.when(k % FEED_NO_ID == 0, F.lit("")).otherwise(ks),
        "num_pages": (F.when(m6 == 0, F.lit("")).when(m6 == 1, F.concat(F.lit(" "), pages, F.lit(" ")))
                      .when(m6 == 2, F.lit("4,000")).when(m6 == 3, F.lit("3.7")).otherwise(pages)),
        "year_published": (k % 30 + 1990).cast("string"),
        "average_rating": F.format_string("%.2f", (k % 500) / F.lit(100.0)),
        "user_rating": (k % 6).cast("string"),
        "read_at": (F.when(k % FEED_UNREAD == 0, F.lit(""))
                    .when(k % FEED_BAD_DATE == 0, F.lit("garbage"))
                    .otherwise(F.concat(F.date_format(finish, "EEE, dd MMM yyyy"),
                                        F.lit(" 22:30:00 -0700")))),
        "date_added": F.date_format(day, "MMMM d, yyyy"),
        "shelves": F.lit("read"),
        "review": F.lit("a review"),
        "book_description": F.lit("<p>about</p>"),
        "cover_url": F.concat(F.lit("https://example.org/c/"), ks, F.lit(".jpg")),
        "goodreads_url": F.concat(F.lit("https://example.org/review/show/"), ks),
        "username": F.col("c_name"),
    }
    cols["title"] = _pick([cols["title"], F.concat(F.lit("Old "), ks)])
    b = _in_batches(j, [k % FEED_ONLY_OLD != 0, (k % FEED_IN_OLD == 0) | (k % FEED_ONLY_OLD == 0)])
    return b.select(*[v.alias(n) for n, v in cols.items()],
                    _pick([F.lit(NEW_BATCH), F.lit(OLD_BATCH)]).cast("timestamp").alias("_ingested_at"),
                    F.lit("rss").alias("_source"))


def bib_json(spark: SparkSession, base: str) -> DataFrame:
    """(p_partkey, raw_json) lookup records built from part rows; see BIB_*."""
    p = read_table(spark, "part", base).select("p_partkey", "p_name", "p_type", "p_brand", "p_size")
    k = _k("p_partkey")
    # JSON string literal of a column: to_json({"v": x}) -> {"v":"x"}; strip the wrapper.
    js = lambda c: F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r'^\{"v":(.*)\}$', 1)
    word = F.split(F.col("p_name"), " ")
    subjects = F.when(k % BIB_MIXED == 0, F.concat(
        F.lit('[{"name": '), js(word[0]), F.lit(', "url": "u"}, "bad", {"url": "z"}, {"name": '),
        js(F.col("p_type")), F.lit("}]"))).otherwise(F.concat(
            F.lit('[{"name": '), js(word[0]), F.lit('}, {"name": '), js(word[1]), F.lit("}]")))
    publishers = F.when(k % BIB_NO_PUBLISHERS == 0, F.lit("null")).otherwise(
        F.concat(F.lit('[{"name": "Pub '), F.col("p_size").cast("string"), F.lit('"}]')))
    m5 = k % 5
    size = F.col("p_size").cast("string")
    pages = (F.when(m5 == 0, F.concat(F.lit(', "number_of_pages": '), size))
             .when(m5 == 1, F.concat(F.lit(', "number_of_pages": null, "pagination": "'), size, F.lit(' p."')))
             .when(m5 == 2, F.concat(F.lit(', "pagination": "'), size, F.lit(' p."')))
             .when(m5 == 3, F.concat(F.lit(', "pagination": "2 v. ('), size, F.lit(' p.)"')))
             .otherwise(F.lit(', "pagination": null')))
    cover = F.when(k % 2 == 0, F.concat(F.lit(', "cover": {"large": "", "medium": "m/'), k.cast("string"),
                                        F.lit('", "small": "s/'), k.cast("string"), F.lit('"}')))\
        .otherwise(F.lit(""))
    body = F.concat(
        F.lit('{"key": "/books/OL'), k.cast("string"), F.lit('M", "title": '), js(F.col("p_name")),
        F.lit(', "subjects": '), subjects,
        F.lit(', "authors": [{"name": '), js(F.col("p_brand")), F.lit("}]"),
        F.lit(', "publishers": '), publishers,
        F.lit(', "publish_date": "'), (k % 30 + 1990).cast("string"), F.lit('"'),
        pages, cover, F.lit("}"))
    raw = F.when(k % BIB_MALFORMED == 0, F.lit("{bad")).otherwise(body)
    return p.select("p_partkey", raw.alias("raw_json"))


def part_books(spark: SparkSession, base: str) -> DataFrame:
    """Users' books from lineitem: (username, book_id, user_rating,
    num_pages, is_read). username = supplier."""
    li = read_table(spark, "lineitem", base).select(
        "l_suppkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag")
    return li.select(
        F.format_string("supp%04d", "l_suppkey").alias("username"),
        F.col("l_partkey").cast("string").alias("book_id"),
        (F.col("l_linenumber") % 6).cast("int").alias("user_rating"),
        (F.col("l_quantity").cast("int") * 10 - 30).alias("num_pages"),
        (F.col("l_returnflag") != "N").alias("is_read"))


def part_subjects(spark: SparkSession, base: str) -> DataFrame:
    """Lookup records per part: (book_id, isbn, status, subjects)."""
    p = read_table(spark, "part", base).select("p_partkey", "p_name", "p_type")
    k = _k("p_partkey")
    name = F.when(k % 9 == 0, F.concat(F.lit("  "), F.col("p_name"), F.lit(" "))).otherwise(F.col("p_name"))
    return p.select(
        k.cast("string").alias("book_id"),
        F.lpad(k.cast("string"), 10, "0").alias("isbn"),
        F.when(k % 13 == 0, F.lit("not_found")).otherwise(F.lit("ok")).alias("status"),
        F.array(name, F.col("p_type")).alias("subjects"))


def lookup_books(spark: SparkSession, base: str) -> DataFrame:
    """(isbn, book_id) requests from lineitem rows; isbn '' for k % 10."""
    # No spread here: a distinct follows, whose partial aggregation is cheap.
    li = read_table(spark, "lineitem", base).select("l_partkey")
    k = _k("l_partkey")
    return li.select(F.when(k % 10 == 0, F.lit("")).otherwise(F.lpad(k.cast("string"), 10, "0")).alias("isbn"),
                     k.cast("string").alias("book_id"))


# Subject names given to derived lookup records (by book id
# modulo their count), a mix that the genre rules map and do not map.
SUBJECTS = ["Science fiction", "Fantasy", "Mystery", "Romance", "Historical", "Young adult",
            "Comics", "Adventure", "Fiction", "Cooking"]


def landed_responses(plan: DataFrame) -> DataFrame:
    """Landed responses per planned chunk: found when book_id % 4 != 0; each
    record carries one subject name from SUBJECTS. Requests for a single key
    fail for book_id % 6 == 5 and are never answered for book_id % 10 == 7."""
    found = F.filter("members", lambda m: m["book_id"].cast("bigint") % 4 != 0)
    names = F.array(*[F.lit(x) for x in SUBJECTS])
    entry = lambda m: F.concat(
        F.lit('"ISBN:'), m["isbn"], F.lit('": {"key": "/books/OL'), m["book_id"], F.lit('M", "title": "T'),
        m["book_id"], F.lit('", "subjects": [{"name": "'),
        F.element_at(names, (m["book_id"].cast("bigint") % len(SUBJECTS) + 1).cast("int")), F.lit('"}]}'))
    body = F.concat(F.lit("{"), F.array_join(F.transform(found, entry), ", "), F.lit("}"))
    single = F.size("members") == 1
    only = F.element_at("members", 1)["book_id"].cast("bigint")
    failed = single & (only % 6 == 5)
    answered = plan.where(~(single & (only % 10 == 7)))
    return answered.select("chunk_id", F.when(~failed, body).alias("body"), F.when(failed, F.lit("HTTP 500")).alias("error"))
