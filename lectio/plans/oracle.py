"""DuckDB SQL oracles for the registered queries.

Each restates the expected result from the source keys with an
independent formulation (EXISTS subqueries instead of joins, ground-truth
dates instead of re-parsing text, a cross join for the dense grid) over
the pre-registered driver views."""

from __future__ import annotations


def _rnd(expr: str, scale: int) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(38,12)), {scale}) AS DOUBLE)"


K = "o.o_orderkey"
DAY = "CAST(o.o_orderdate AS DATE)"

READINGS_TEMPLATE = f"""
readings AS (
  SELECT {{user}} AS username,
         CAST({K} AS VARCHAR) AS book_id,
         CAST({K} AS VARCHAR) AS title,
         CASE WHEN {K} % 97 = 3 THEN NULL ELSE {DAY} END AS started_reading,
         CASE WHEN {K} % 89 = 5 THEN NULL
              WHEN {K} % 101 = 17 THEN CAST({DAY} - 2 AS DATE)
              ELSE CAST({DAY} + CAST({K} % 14 AS INTEGER) AS DATE) END AS read_at,
         CASE WHEN {K} % 83 = 11 THEN NULL
              WHEN {K} % 79 = 13 THEN 0
              ELSE CAST({K} % 400 + 50 AS INTEGER) END AS num_pages,
         {K} AS k, {DAY} AS day0
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"""

READINGS = READINGS_TEMPLATE.replace("{user}", "c.c_name")
READINGS_NATION = READINGS_TEMPLATE.replace("{user}", "printf('user%02d', c.c_nationkey)")

GOLD_BODY = """,
ok AS (SELECT * FROM readings WHERE started_reading IS NOT NULL AND read_at IS NOT NULL
       AND num_pages IS NOT NULL AND num_pages > 0 AND started_reading <= read_at),
flagged AS (
  SELECT ok.*,
    EXISTS (SELECT 1 FROM ok o2 WHERE o2.username = ok.username
            AND o2.read_at = ok.started_reading) AS start_shares_finish,
    EXISTS (SELECT 1 FROM ok o2 WHERE o2.username = ok.username
            AND o2.started_reading = ok.read_at) AS finish_shares_start
  FROM ok),
eff AS (
  SELECT *, CASE WHEN started_reading = read_at THEN 1.0
    ELSE CAST(read_at - started_reading + 1 AS DOUBLE)
         - CASE WHEN start_shares_finish THEN 0.5 ELSE 0.0 END
         - CASE WHEN finish_shares_start THEN 0.5 ELSE 0.0 END END AS effective_reading_days
  FROM flagged),
days AS (
  SELECT username, title, started_reading, read_at, num_pages, start_shares_finish,
         finish_shares_start, effective_reading_days,
         CAST(unnest(generate_series(CAST(started_reading AS TIMESTAMP), CAST(read_at AS TIMESTAMP),
                                     INTERVAL 1 DAY)) AS DATE) AS date
  FROM eff),
contrib AS (
  SELECT username, date, title,
    num_pages * (CASE WHEN started_reading = read_at THEN 1.0
                      WHEN date = started_reading AND start_shares_finish THEN 0.5
                      WHEN date = read_at AND finish_shares_start THEN 0.5
                      ELSE 1.0 END) / effective_reading_days AS amt
  FROM days),
agg AS (SELECT username, date, sum(amt) AS tot, list_sort(list(title)) AS titles
        FROM contrib GROUP BY username, date),
bounds AS (SELECT username, min(started_reading) AS lo, max(read_at) AS hi FROM ok GROUP BY username),
spine AS (SELECT username, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP),
                                                       INTERVAL 1 DAY)) AS DATE) AS date FROM bounds),
gold AS (
  SELECT spine.username, spine.date,
         """ + _rnd("coalesce(agg.tot, 0.0)", 1) + """ AS est_pages_read,
         coalesce(agg.titles, []::VARCHAR[]) AS titles
  FROM spine LEFT JOIN agg ON spine.username = agg.username AND spine.date = agg.date)"""

GOLD = READINGS + GOLD_BODY
GOLD_DENSE = READINGS_NATION + GOLD_BODY


def _rolling(n: int, where: str = "") -> str:
    return ("WITH " + GOLD + f"""
SELECT username, date, est_pages_read,
  {_rnd(f"avg(est_pages_read) OVER (PARTITION BY username ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)", 6)} AS rolling_mean
FROM gold {where}""")


FEED_K = "o_orderkey"
FEED_READ_AT = (f"CASE WHEN {FEED_K} % 9 = 0 OR {FEED_K} % 41 = 0 THEN NULL "
                f"ELSE CAST(CAST(o_orderdate AS DATE) + CAST({FEED_K} % 14 AS INTEGER) AS DATE) END")
TYPED = f"""
SELECT CAST({FEED_K} AS VARCHAR) AS book_id, 'Book ' || CAST({FEED_K} AS VARCHAR) AS title,
  c_name AS username,
  CASE WHEN {FEED_K} % 6 IN (1, 4, 5) THEN CAST({FEED_K} % 400 + 50 AS INTEGER) END AS num_pages,
  CAST({FEED_K} % 30 + 1990 AS INTEGER) AS year_published,
  CAST({FEED_K} % 500 AS DOUBLE) / 100.0 AS average_rating,
  CAST({FEED_K} % 6 AS INTEGER) AS user_rating,
  {FEED_READ_AT} AS read_at,
  CAST(o_orderdate AS DATE) AS date_added,
  ({FEED_READ_AT}) IS NOT NULL AS is_read
FROM orders JOIN customer ON o_custkey = c_custkey
WHERE {FEED_K} % 13 <> 0 AND {FEED_K} % 37 <> 0"""

FEED_SCAN = f"""
SELECT CASE WHEN batch = 2 THEN 'Book ' ELSE 'Old ' END || CAST(o_orderkey AS VARCHAR) AS title, c_name AS author,
  CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE lpad(CAST(o_orderkey AS VARCHAR), 10, '0') END AS isbn,
  CASE WHEN o_orderkey % 37 = 0 THEN '' ELSE CAST(o_orderkey AS VARCHAR) END AS book_id,
  CASE o_orderkey % 6 WHEN 0 THEN '' WHEN 1 THEN ' ' || CAST(o_orderkey % 400 + 50 AS VARCHAR) || ' '
       WHEN 2 THEN '4,000' WHEN 3 THEN '3.7' ELSE CAST(o_orderkey % 400 + 50 AS VARCHAR) END AS num_pages,
  CASE WHEN o_orderkey % 9 = 0 THEN '' WHEN o_orderkey % 41 = 0 THEN 'garbage'
       ELSE strftime(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 14 AS INTEGER), '%a, %d %b %Y')
            || ' 22:30:00 -0700' END AS read_at,
  CAST(o_orderkey % 30 + 1990 AS VARCHAR) AS year_published,
  printf('%.2f', CAST(o_orderkey % 500 AS DOUBLE) / 100.0) AS average_rating,
  CAST(o_orderkey % 6 AS VARCHAR) AS user_rating,
  strftime(CAST(o_orderdate AS DATE), '%B %-d, %Y') AS date_added,
  'read' AS shelves, 'a review' AS review, '<p>about</p>' AS book_description,
  'https://example.org/c/' || CAST(o_orderkey AS VARCHAR) || '.jpg' AS cover_url,
  'https://example.org/review/show/' || CAST(o_orderkey AS VARCHAR) AS goodreads_url,
  c_name AS username
FROM orders JOIN customer ON o_custkey = c_custkey CROSS JOIN (VALUES (1), (2)) b(batch)
WHERE (batch = 2 AND o_orderkey % 13 <> 0) OR (batch = 1 AND (o_orderkey % 4 = 0 OR o_orderkey % 13 = 0))"""


def _norm(s: str) -> str:
    return f"lower(trim({s}))"


def _any(cond: str) -> str:
    return f"len(list_filter(subjects, lambda s: {cond})) > 0"


def _part_rules_sql() -> str:
    n = _norm("s")
    rules = [
        ("Fastener", f"contains({n}, 'bolt') OR {n} IN ('small ring', 'large ring')"),
        ("Machinery", f"contains({n}, 'gear') OR contains({n}, 'gizmo') OR contains({n}, 'widget')"),
        ("Heavy", f"contains({n}, 'anvil') OR contains({n}, 'plate') OR starts_with({n}, 'large')"),
        ("Thermal", f"starts_with({n}, 'hot') OR starts_with({n}, 'cold')"),
        ("Colour", f"starts_with({n}, 'red') OR starts_with({n}, 'blue')"),
        ("Bargain", f"{n} IN ('economy', 'promo')"),
    ]
    items = ", ".join(f"CASE WHEN {_any(c)} THEN '{lab}' END" for lab, c in rules)
    return f"list_sort(list_filter([{items}], lambda x: x IS NOT NULL))"


SUBJECTS = f"""
subj AS (
  SELECT CAST(p_partkey AS VARCHAR) AS book_id, p_partkey % 13 <> 0 AS ok_status,
         [CASE WHEN p_partkey % 9 = 0 THEN '  ' || p_name || ' ' ELSE p_name END, p_type] AS subjects
  FROM part),
cls AS (SELECT book_id, ok_status, subjects, {_part_rules_sql()} AS genres FROM subj)"""

GENRE = "WITH " + SUBJECTS + """,
books AS (
  SELECT printf('supp%04d', l_suppkey) AS username, CAST(l_partkey AS VARCHAR) AS book_id,
         CAST(l_linenumber % 6 AS INTEGER) AS user_rating,
         CAST(trunc(l_quantity) AS INTEGER) * 10 - 30 AS num_pages,
         l_returnflag <> 'N' AS is_read
  FROM lineitem),
qb AS (SELECT * FROM books WHERE is_read AND user_rating > 0 AND num_pages > 0),
j AS (SELECT qb.username, qb.book_id, qb.user_rating, qb.num_pages, cls.genres, cls.subjects
      FROM qb JOIN cls ON qb.book_id = cls.book_id WHERE cls.ok_status),
ex AS (SELECT username, user_rating, num_pages, unnest(genres) AS genre FROM j WHERE len(genres) > 0),
summ AS (
  SELECT username, genre,
         """ + _rnd("avg(user_rating)", 2) + """ AS avg_user_rating,
         CAST(sum(num_pages) AS INTEGER) AS total_pages,
         CAST(count(*) AS INTEGER) AS book_count
  FROM ex GROUP BY username, genre)
"""

LOOKUP_KEYS = """
keys AS (
  SELECT DISTINCT lpad(CAST(l_partkey AS VARCHAR), 10, '0') AS isbn, CAST(l_partkey AS VARCHAR) AS book_id,
         l_partkey AS k
  FROM lineitem WHERE l_partkey % 10 <> 0)"""

RESOLVE = "WITH " + LOOKUP_KEYS + """,
res AS (
  SELECT isbn, book_id, CASE WHEN k % 4 <> 0 THEN 'ok' ELSE 'not_found' END AS status,
         CASE WHEN k % 4 <> 0 THEN '/books/OL' || book_id || 'M' END AS ol_key, true AS has_url
  FROM keys)
"""

SINGLE = "WITH " + LOOKUP_KEYS + """,
res AS (
  SELECT isbn, book_id, CASE WHEN k % 10 = 7 THEN 'error: no response landed' WHEN k % 6 = 5 THEN 'error: HTTP 500'
                             WHEN k % 4 <> 0 THEN 'ok' ELSE 'not_found' END AS status
  FROM keys)
"""

PK = "p_partkey"
BIB = f"""
SELECT {PK} AS p_partkey,
  CASE WHEN {PK} % 17 <> 0 THEN '/books/OL' || CAST({PK} AS VARCHAR) || 'M' END AS ol_key,
  CASE WHEN {PK} % 17 <> 0 THEN p_name END AS ol_title,
  CASE WHEN {PK} % 17 = 0 THEN ''
       WHEN {PK} % 3 = 0 THEN array_to_string(list_sort([split_part(p_name, ' ', 1), p_type]), '|')
       ELSE array_to_string(list_sort([split_part(p_name, ' ', 1), split_part(p_name, ' ', 2)]), '|')
  END AS subjects,
  CASE WHEN {PK} % 17 = 0 THEN '' ELSE p_brand END AS authors,
  CASE WHEN {PK} % 17 = 0 OR {PK} % 4 = 0 THEN '' ELSE 'Pub ' || CAST(p_size AS VARCHAR) END AS publishers,
  CAST(CASE WHEN {PK} % 17 = 0 THEN 0 ELSE 2 END AS INTEGER) AS n_subjects,
  CASE WHEN {PK} % 17 <> 0 THEN CAST({PK} % 30 + 1990 AS VARCHAR) END AS publish_date,
  CASE WHEN {PK} % 17 = 0 THEN NULL
       WHEN {PK} % 5 IN (0, 1, 2) THEN p_size
       WHEN {PK} % 5 = 3 THEN CAST('2' || CAST(p_size AS VARCHAR) AS INTEGER)
       ELSE NULL END AS number_of_pages,
  CASE WHEN {PK} % 17 <> 0 AND {PK} % 2 = 0 THEN 'm/' || CAST({PK} AS VARCHAR) END AS cover_url
FROM part"""

ENRICH = "WITH " + READINGS + """
SELECT book_id, username, title, read_at,
  CASE WHEN k % 11 = 0 THEN NULL
       WHEN k % 7 NOT IN (0, 4) THEN day0
       WHEN k % 5 = 0 THEN CAST(day0 - 400 AS DATE)
       ELSE NULL END AS started_reading
FROM readings"""

DAY_OF = "CAST(o_orderdate AS DATE)"

ORACLES: dict[str, str] = {
    "daily_allocation": "WITH " + GOLD + """
SELECT username, date, est_pages_read, CAST(len(titles) AS INTEGER) AS n_books,
       array_to_string(titles, '|') AS book_titles FROM gold""",
    "daily_allocation_dense": "WITH " + GOLD_DENSE + """
SELECT username, date, est_pages_read, CAST(len(titles) AS INTEGER) AS n_books,
       array_to_string(titles, '|') AS book_titles FROM gold""",
    "daily_ordered": "WITH " + GOLD + """
SELECT row_number() OVER (ORDER BY username, date) AS position, username, date, est_pages_read,
       CAST(len(titles) AS INTEGER) AS books_in_progress FROM gold""",
    "daily_rounded": "WITH " + GOLD_DENSE + " SELECT username, date, est_pages_read FROM gold",
    "genre_ordered": GENRE + "SELECT row_number() OVER (ORDER BY username, genre) AS position, * FROM summ",
    "daily_allocation_sparse": "WITH " + GOLD + """
SELECT username, date, est_pages_read, CAST(len(titles) AS INTEGER) AS n_books,
       array_to_string(titles, '|') AS book_titles FROM gold""",
    "shared_boundaries": "WITH " + GOLD + """
SELECT username, title, started_reading, read_at, start_shares_finish, finish_shares_start,
       effective_reading_days FROM eff""",
    "skipped_report": "WITH " + READINGS + """
SELECT * FROM (
  SELECT username, title, started_reading, read_at, num_pages,
    CASE WHEN started_reading IS NULL THEN 'missing_start'
         WHEN read_at IS NULL THEN 'missing_finish'
         WHEN num_pages IS NULL THEN 'missing_amount'
         WHEN num_pages <= 0 THEN 'non_positive_amount'
         WHEN started_reading > read_at THEN 'inverted_interval' END AS reason
  FROM readings) WHERE reason IS NOT NULL""",
    "rolling_mean_7": _rolling(7),
    "rolling_mean_range": _rolling(30, "WHERE date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'"),
    "daily_view": "WITH " + GOLD + """
SELECT username, date, est_pages_read, CAST(len(titles) AS INTEGER) AS books_in_progress,
       array_to_string(list_transform(titles, lambda t: '• ' || t), '<br>') AS titles_label FROM gold""",
    "labels_joined": "WITH " + GOLD + """
SELECT username, date, array_to_string(list_transform(titles, lambda t: '• ' || t), '<br>') AS titles_label
FROM gold""",
    "date_domain": "WITH " + GOLD + " SELECT min(date) AS min_date, max(date) AS max_date FROM gold",
    "latest_batch": """
SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS day FROM events
WHERE date_trunc('day', ts) = (SELECT max(date_trunc('day', ts)) FROM events) AND event_type <> ''""",
    "typed_clean": TYPED,
    "feed_to_silver": TYPED,
    "date_parse": f"""
SELECT o_orderkey,
  CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE {DAY_OF} END AS d_long,
  {DAY_OF} AS d_rfc,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE {DAY_OF} END AS d_iso,
  CASE WHEN o_orderkey % 8 = 5 THEN NULL ELSE {DAY_OF} END AS d_other,
  {DAY_OF} AS d_clock
FROM orders""",
    "feed_scan": FEED_SCAN,
    "enrich_left": ENRICH,
    "html_last_labelled": """
SELECT page_id, CASE WHEN contains(t, '.') AND contains(t, 'th') THEN trim(split_part(t, '.', 1)) END AS ad_head
FROM (SELECT page_id, regexp_extract(html, '(?s)<div class="ad">(.*?)</div>', 1) AS t FROM pages)""",
    "page_validity": "WITH " + READINGS + " SELECT book_id, username, k % 11 <> 0 AND k % 23 <> 0 AS page_valid FROM readings",
    "page_quarantine": "WITH " + READINGS + """
SELECT book_id, username, k % 11 = 0 AS missing FROM readings WHERE k % 11 = 0 OR k % 23 = 0""",
    "page_accepted": "WITH " + READINGS + " SELECT book_id, username FROM readings WHERE k % 11 <> 0 AND k % 23 <> 0",
    "date_rejects": """
SELECT 'read_at' AS "column", 'garbage' AS text, count(*) AS n FROM (
  SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 13 <> 0
  UNION ALL SELECT o_orderkey FROM orders WHERE o_orderkey % 4 = 0 OR o_orderkey % 13 = 0)
WHERE k % 9 <> 0 AND k % 41 = 0 HAVING count(*) > 0""",
    "silver_overwritten": TYPED,
    "silver_switched": TYPED,
    "bronze_partitions": """
SELECT CASE WHEN o_orderkey % 37 = 0 THEN '' ELSE CAST(o_orderkey AS VARCHAR) END AS book_id, c_name AS username,
       'n' || CASE WHEN o_orderkey % 37 = 0 THEN '' ELSE CAST(o_orderkey AS VARCHAR) END AS rating_note,
       count(*) OVER () + (SELECT count(*) FROM orders WHERE o_orderkey % 4 = 0 OR o_orderkey % 13 = 0) AS n_history
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 13 <> 0""",
    "run_metrics": """
SELECT 'r1' AS run, 'books' AS stage, t AS "table",
       count(*) FILTER (WHERE t = 'bronze_rss' OR o_orderkey % 37 <> 0) AS rows
FROM orders CROSS JOIN (VALUES ('bronze_rss'), ('silver_books')) v(t) WHERE o_orderkey % 13 <> 0 GROUP BY t""",
    "bronze_widened": """
SELECT book_id, username, CASE WHEN batch = 2 THEN 'n' || book_id ELSE 'none' END AS rating_note FROM (
  SELECT CASE WHEN o_orderkey % 37 = 0 THEN '' ELSE CAST(o_orderkey AS VARCHAR) END AS book_id, c_name AS username, batch
  FROM orders JOIN customer ON o_custkey = c_custkey CROSS JOIN (VALUES (1), (2)) b(batch)
  WHERE (batch = 2 AND o_orderkey % 13 <> 0) OR (batch = 1 AND (o_orderkey % 4 = 0 OR o_orderkey % 13 = 0)))""",
    "json_array": """
SELECT p_partkey, CAST(CASE WHEN p_partkey % 7 < 3 THEN 0 ELSE 2 END AS INTEGER) AS n,
       CASE WHEN p_partkey % 7 < 3 THEN '' ELSE p_brand || '|' || p_type END AS joined FROM part""",
    "metric_pick": GENRE + "SELECT username, genre, 'total_pages' AS metric, CAST(total_pages AS DOUBLE) AS value FROM summ",
    "lookup_requests": "WITH " + LOOKUP_KEYS + """
SELECT CAST(ceil(count(*) / 20.0) AS BIGINT) AS n_requests, count(*) AS n_keys, CAST(least(count(*), 20) AS INTEGER) AS largest
FROM keys""",
    "bib_record": BIB,
    "keyword_classify": "WITH " + SUBJECTS + """
SELECT book_id, array_to_string(genres, '|') AS labels, CAST(len(genres) AS INTEGER) AS n_labels FROM cls""",
    "genre_summary": GENRE + "SELECT * FROM summ",
    "genre_view": GENRE + "SELECT * FROM summ",
    "genre_unmatched": GENRE + """
SELECT username, book_id, array_to_string(list_sort(subjects), '|') AS subjects FROM j WHERE len(genres) = 0""",
    "genre_coverage": GENRE + "SELECT count(DISTINCT book_id) AS books_with_genre FROM j WHERE len(genres) > 0",
    "dense_matrix": GENRE + """,
users AS (SELECT DISTINCT username FROM summ), gs AS (SELECT DISTINCT genre FROM summ)
SELECT u.username, g.genre, coalesce(s.avg_user_rating, 0) AS avg_user_rating,
       coalesce(s.total_pages, 0) AS total_pages, coalesce(s.book_count, 0) AS book_count
FROM users u CROSS JOIN gs g LEFT JOIN summ s ON s.username = u.username AND s.genre = g.genre""",
    "metric_long": GENRE + """
SELECT username, genre, 'avg_user_rating' AS metric, CAST(avg_user_rating AS DOUBLE) AS value FROM summ
UNION ALL SELECT username, genre, 'total_pages', CAST(total_pages AS DOUBLE) FROM summ
UNION ALL SELECT username, genre, 'book_count', CAST(book_count AS DOUBLE) FROM summ""",
    "lookup_plan": "WITH " + LOOKUP_KEYS + " SELECT isbn, book_id, true AS chunk_ok, true AS in_url FROM keys",
    "lookup_resolve": RESOLVE + "SELECT * FROM res",
    "lookup_status": SINGLE + "SELECT split_part(status, ':', 1) AS status_class, count(*) AS n FROM res GROUP BY ALL",
    "lookup_errors": SINGLE + """
SELECT isbn, book_id, status, NOT starts_with(status, 'error') AS has_url FROM res WHERE status <> 'ok'""",
}
