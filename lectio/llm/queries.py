"""The registered queries of the subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from lectio.llm import (attribution, bisector_tournament, collision_search, feistel, inverted_multi_index, order_minhash,
                        quality_ledger, quotations, radix_dedup, source_mix, url_automaton, warc_index)
from lectio.llm.bpe_automaton import encode_documents
from lectio.llm.common import byte_bpe_path, table


def quoting_mail(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, text): the conversations as mail in which each message
    quotes the one before it. Every third message quotes it whole, with that
    one's quote of its own predecessor; every third only its last line; and
    every third its first line, an answer, and then its other lines."""
    said = conversations.groupBy("conv_id", "turn").agg(F.min(F.struct("text", "role")).alias("said"))

    def earlier(n: int) -> DataFrame:
        return said.select(F.col("conv_id"), (F.col("turn") + n).alias("turn"), F.col("said").alias(f"said_{n}"))

    def marked(text: Column, level: int = 1) -> Column:
        for _ in range(level):
            text = F.regexp_replace(text, r"(?m)^", "> ")
        return text

    def intro(n: int) -> Column:
        return F.concat(F.lit("On turn "), (F.col("turn") - n).cast("string"), F.lit(", "),
                        F.coalesce(F.col(f"said_{n}.role"), F.lit("somebody")), F.lit(" wrote:\n"))

    def whole(n: int) -> Column:
        text = F.concat(intro(n), marked(F.coalesce(F.col(f"said_{n}.text"), F.lit(""))))
        return F.when(F.col(f"said_{n}").isNotNull(), F.concat(F.lit("\n\n" if n == 1 else "\n>\n"), marked(text, n - 1))).otherwise(F.lit(""))

    lines = F.filter(F.split(F.coalesce(F.col("said_1.text"), F.lit("")), "\n"), lambda x: x.rlike(r"\S"))
    lead = F.concat(F.lit("\n\n"), intro(1))
    trimmed = F.concat(lead, marked(F.element_at(lines, -1)))
    rest = F.array_join(F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0))), "\n")
    answered = F.concat(lead, marked(F.element_at(lines, 1)), F.lit("\nNoted on turn "), F.col("turn").cast("string"), F.lit(".\n"),
                        F.when(F.size(lines) > 1, marked(rest)).otherwise(F.lit("")))
    quotes = (F.when(F.col("turn") % 3 == 0, F.concat(whole(1), whole(2)))
              .when(F.col("said_1").isNull() | (F.size(lines) == 0), F.lit(""))
              .when(F.col("turn") % 3 == 1, trimmed).otherwise(answered))
    mail = conversations.join(earlier(1), ["conv_id", "turn"], "left").join(earlier(2), ["conv_id", "turn"], "left")
    return mail.select("conv_id", "turn", F.concat(F.coalesce("text", F.lit("")), quotes).alias("text"))


def op1_quotations(spark: SparkSession, base: str) -> DataFrame:
    return quotations.reply_order(quoting_mail(table(spark, base, "conversations")))


def op2_rule_ledger(spark: SparkSession, base: str) -> DataFrame:
    ledger = quality_ledger.quality_ledger(table(spark, base, "documents"))
    return ledger.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         (~quality_ledger.passes("base-1")).alias("base_failed"), quality_ledger.passes().alias("kept"),
                         "failed_bits")


def rule_ablations(spark: SparkSession, base: str) -> DataFrame:
    """What each rule of each policy version rejects over all documents, and
    what leaving it out would bring back."""
    return quality_ledger.ablations(quality_ledger.quality_ledger(table(spark, base, "documents")))


def op3_radix_dedup(spark: SparkSession, base: str) -> DataFrame:
    return radix_dedup.equal_text_groups(table(spark, base, "documents"))


def op4_warc_index(spark: SparkSession, base: str) -> DataFrame:
    pages = table(spark, base, "pages")
    records = warc_index.read_archives(warc_index.write_archives(pages))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type",
                          F.col("refers_to").cast(pages.schema["page_id"].dataType).alias("refers_to"))


def op5_feistel(spark: SparkSession, base: str) -> DataFrame:
    """The key is a secret of the deployment; tests and trials have one."""
    key = spark.conf.get("spark.lectio.pseudonymKey", "trial-key")
    return feistel.pseudonymise(table(spark, base, "documents"), key.encode())


def op6_order_minhash(spark: SparkSession, base: str) -> DataFrame:
    return order_minhash.near_duplicates(table(spark, base, "documents")).drop("text_key")


def op7_attribution(spark: SparkSession, base: str) -> DataFrame:
    return attribution.attribute_tokens(table(spark, base, "documents"), byte_bpe_path(), ("source", "lang", "text"),
                                        sections={"text": attribution.paragraphs}, rule="most")


def op8_source_mix(spark: SparkSession, base: str) -> DataFrame:
    mix = source_mix.mix_sources(table(spark, base, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "epochs", "source")


def op9_bpe_automaton(spark: SparkSession, base: str) -> DataFrame:
    return encode_documents(table(spark, base, "documents"), byte_bpe_path(), with_ids=False)


#: Rules with a label are the ones results name; the others are the filter's
#: own list of unwanted hosts and paths.
URL_RULES = (
    url_automaton.host_rule("org", "/", "allow"),
    url_automaton.host_rule("example.org", "/es/", "block"),
    url_automaton.host_rule("example.org", "/en/1", "block"),
    url_automaton.host_rule("com", "/fr/", "allow"),
    url_automaton.host_rule("com", "/de/", "block"),
    *(url_automaton.UrlRule(glob, "block") for glob in (
        "*.casino-*/**", "*.adult-*/**", "*.free-bets.*/**", "*.spam-*/**", "**/wp-login.php**", "**/cgi-bin/**")),
)


def op10_url_automaton(spark: SparkSession, base: str) -> DataFrame:
    return url_automaton.judge_urls(table(spark, base, "pages"), URL_RULES).drop("n_matches")


def op11_multi_index(spark: SparkSession, base: str) -> DataFrame:
    """A seventh of the labels is moved on by one, so that labels don't
    simply follow the vectors."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, base, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return inverted_multi_index.hard_negatives(rows, F.col("vec_id") % 100 == 0)


def op12_collision_search(spark: SparkSession, base: str) -> DataFrame:
    return collision_search.nearest(table(spark, base, "embeddings"), F.col("vec_id") % 100 == 0)


def op13_bisector_tournament(spark: SparkSession, base: str) -> DataFrame:
    return bisector_tournament.cluster_vectors(table(spark, base, "embeddings"))


LLM_QUERIES = {f.__name__: f for f in (
    op1_quotations, op2_rule_ledger, op3_radix_dedup, op4_warc_index, op5_feistel, op6_order_minhash,
    op7_attribution, op8_source_mix, op9_bpe_automaton, op10_url_automaton, op11_multi_index, op12_collision_search,
    op13_bisector_tournament)}
LLM_QUERIES["pipeline"] = corpus_pipeline.run
LLM_QUERIES["rule_ablations"] = rule_ablations

_FINITE = "list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))"
_WHOLE = "list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT)"


def _lloyd_sql(rounds: int = 5, k: int = 40) -> str:
    """Nearest-centroid rounds with all distances spelled out."""
    parts = [f"""
x AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, {_WHOLE} AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = 64 AND {_FINITE}),
c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY h, v) - 1)::INT AS c, v FROM (
  SELECT sha256('2:' || vec_id) AS h, v FROM x ORDER BY h, v LIMIT {k}))"""]
    for n in range(rounds + 1):
        parts.append(f"""
a{n} AS MATERIALIZED (
  SELECT r, any_value(vec_id) AS vec_id, any_value(xv) AS v, min(struct_pack(d := d, c := c)) AS w FROM (
    SELECT x.r, x.vec_id, x.v AS xv, c.c,
           list_sum(list_transform(list_zip(x.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
    FROM x CROSS JOIN c{n} c) GROUP BY r)""")
        if n < rounds:
            parts.append(f"""
m{n} AS MATERIALIZED (
  SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v FROM (
    SELECT w.c AS c, i, sum(v[i])::BIGINT AS s, count(*)::BIGINT AS n
    FROM a{n} CROSS JOIN (SELECT unnest(range(1, 65)) AS i) GROUP BY ALL) GROUP BY c),
c{n + 1} AS MATERIALIZED (SELECT c.c, coalesce(m.v, c.v) AS v FROM c{n} c LEFT JOIN m{n} m ON m.c = c.c)""")
    return "WITH " + ",".join(parts) + f"""
SELECT vec_id, w.c AS cluster, w.d AS distance, sum(w.d) OVER (PARTITION BY w.c)::BIGINT AS cluster_inertia,
       sum(w.d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.c = a.w.c"""


LLM_ORACLES = {
    "op11_multi_index": f"""
WITH x AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, {_WHOLE} AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND {_FINITE}),
s AS MATERIALIZED (
  SELECT a.r AS ar, a.vec_id AS anchor_id, x.r, x.vec_id, x.label = a.label AS same,
         list_sum(list_transform(list_zip(a.v, x.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM x a JOIN x ON x.r <> a.r WHERE a.vec_id % 100 = 0),
p AS (
  SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         (row_number() OVER (PARTITION BY p.ar, p.r ORDER BY n.score DESC, n.vec_id))::INT AS rank
  FROM p JOIN s n ON n.ar = p.ar AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score)
WHERE rank <= 10""",
    "op13_bisector_tournament": _lloyd_sql(),
    "op1_quotations": r"""
WITH RECURSIVE said AS (SELECT conv_id, turn, min(coalesce(text, '')) AS t FROM conversations GROUP BY ALL),
paras AS (
  SELECT conv_id, turn, trim(regexp_replace(lower(p), '\s+', ' ', 'g')) AS w
  FROM (SELECT conv_id, turn, unnest(regexp_split_to_array(t, '\n[ \t]*\n')) AS p FROM said)
  WHERE regexp_matches(p, '\S')),
lines AS (
  SELECT conv_id, turn, i, trim(regexp_replace(lower(l), '\s+', ' ', 'g')) AS l
  FROM (SELECT conv_id, turn, unnest(string_split(t, chr(10))) AS l, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM said)
  WHERE regexp_matches(l, '\S')),
owners AS (SELECT conv_id, w, min(turn) AS owner FROM paras GROUP BY ALL),
firsts AS (SELECT w, min(struct_pack(c := conv_id, t := owner)) AS f FROM owners GROUP BY w),
line_owners AS (SELECT conv_id, l, min(turn) AS said_turn FROM lines WHERE len(string_split(l, ' ')) >= 3 GROUP BY ALL),
ends AS (SELECT conv_id, turn, min(i) AS i0, max(i) AS i1 FROM lines GROUP BY ALL),
pieces AS (
  SELECT m.conv_id, m.turn, m.turn - p.turn AS level, p.w, []::VARCHAR[] AS ls
  FROM said m JOIN paras p ON p.conv_id = m.conv_id AND p.turn IN (m.turn - 1, m.turn - 2) WHERE m.turn % 3 = 0
  UNION ALL
  SELECT m.conv_id, m.turn, 1, l.l, [l.l] FROM said m JOIN ends e ON e.conv_id = m.conv_id AND e.turn = m.turn - 1
  JOIN lines l ON l.conv_id = e.conv_id AND l.turn = e.turn AND l.i = CASE WHEN m.turn % 3 = 1 THEN e.i1 ELSE e.i0 END
  WHERE m.turn % 3 <> 0
  UNION ALL
  SELECT m.conv_id, m.turn, 1, string_agg(l.l, ' ' ORDER BY l.i), list(l.l) FROM said m
  JOIN ends e ON e.conv_id = m.conv_id AND e.turn = m.turn - 1
  JOIN lines l ON l.conv_id = e.conv_id AND l.turn = e.turn AND l.i > e.i0
  WHERE m.turn % 3 = 2 GROUP BY m.conv_id, m.turn),
numbered AS (SELECT row_number() OVER () AS n, * FROM pieces),
by_line AS (
  SELECT n, max(o.said_turn) AS line_turn
  FROM (SELECT n, conv_id, turn, unnest(ls) AS l FROM numbered) x JOIN line_owners o ON o.conv_id = x.conv_id AND o.l = x.l AND o.said_turn < x.turn
  GROUP BY n),
linked AS (
  SELECT p.conv_id, p.turn, p.level,
         CASE WHEN o.owner IS NOT NULL THEN p.conv_id WHEN f.f IS NOT NULL THEN f.f.c WHEN b.line_turn IS NOT NULL THEN p.conv_id END AS from_conv,
         coalesce(o.owner, f.f.t, b.line_turn) AS from_turn
  FROM numbered p LEFT JOIN owners o ON o.conv_id = p.conv_id AND o.w = p.w AND o.owner <= p.turn
  LEFT JOIN firsts f ON f.w = p.w LEFT JOIN by_line b ON b.n = p.n),
n AS (SELECT conv_id, turn, count(*) AS q, count(from_turn) AS k FROM linked GROUP BY ALL),
parents AS (
  SELECT conv_id, turn, max(from_turn) AS parent_turn FROM linked
  WHERE level = 1 AND from_conv = conv_id AND from_turn < turn GROUP BY ALL),
tree AS (
  SELECT m.conv_id, m.turn, NULL::BIGINT AS parent_turn, m.turn AS root_turn, 0::BIGINT AS depth
  FROM said m LEFT JOIN parents p USING (conv_id, turn) WHERE p.parent_turn IS NULL
  UNION ALL
  SELECT p.conv_id, p.turn, p.parent_turn, t.root_turn, t.depth + 1
  FROM parents p JOIN tree t ON t.conv_id = p.conv_id AND t.turn = p.parent_turn)
SELECT c.conv_id, c.turn, tree.parent_turn, tree.root_turn, tree.depth,
       coalesce(n.q, 0)::BIGINT AS n_quotes, coalesce(n.k, 0)::BIGINT AS n_linked,
       trim(regexp_replace(coalesce(c.text, '') || CASE WHEN c.turn % 3 = 2 AND e.i0 IS NOT NULL THEN chr(10) || chr(10) || 'Noted on turn ' || c.turn || '.'
                                                        ELSE '' END, '\n{3,}', chr(10) || chr(10), 'g'), chr(10)) AS own_text
FROM conversations c JOIN tree ON tree.conv_id = c.conv_id AND tree.turn = c.turn
LEFT JOIN n ON n.conv_id = c.conv_id AND n.turn = c.turn
LEFT JOIN ends e ON e.conv_id = c.conv_id AND e.turn = c.turn - 1""",
    "op2_rule_ledger": r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
windows AS (
  SELECT rid, i, array_to_string(list_slice(w, i::INT, (i + 4)::INT), ' ') AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
hits AS (
  SELECT DISTINCT rid, unnest(range(i, i + 5)) AS at
  FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM windows) WHERE c > 1),
reps AS (SELECT rid, count(*) AS n_repeat_words FROM hits GROUP BY rid),
lines AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY rid),
stutters AS (
  SELECT rid, count(*) AS n_stutters
  FROM (SELECT rid, w, unnest(range(1, len(w))) AS i FROM d) WHERE w[i] = w[i + 1] GROUP BY rid),
m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, len(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         len(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         coalesce(n_lines, 0)::BIGINT AS n_lines, len(regexp_replace(t, '[^!]', '', 'g'))::BIGINT AS n_exclaims,
         coalesce(n_stutters, 0)::BIGINT AS n_stutters
  FROM d LEFT JOIN reps USING (rid) LEFT JOIN lines USING (rid) LEFT JOIN stutters USING (rid)),
b AS (
  SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 2 * n_exclaims > n_words THEN 8 ELSE 0 END
    + CASE WHEN 10 * n_dup_lines > 6 * n_lines THEN 16 ELSE 0 END
    + CASE WHEN 10 * n_stutters > 4 * n_words THEN 32 ELSE 0 END)::BIGINT AS failed_bits
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failed_bits & 3) <> 0 AS base_failed, failed_bits = 0 AS kept, failed_bits
FROM b""",
    "op3_radix_dedup": """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d""",
    "op4_warc_index": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (
  SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha256(h) AS payload_digest,
         CASE WHEN strlen(h) >= 100 THEN min(page_id) OVER (PARTITION BY h) ELSE page_id END AS first_id
  FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first_id = page_id THEN NULL ELSE first_id END AS refers_to
FROM q""",
    "op8_source_mix": r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix-1:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS key
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (
  SELECT *, ([3, 1, 2])[((row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1)::INT]::BIGINT AS w,
         2 * source_size AS cap
  FROM s),
c AS (
  SELECT *, coalesce(sum(cap) OVER before, 0)::BIGINT AS cap_before, coalesce(sum(w) OVER before, 0)::BIGINT AS w_before,
         sum(source_size) OVER ()::BIGINT AS size_all, sum(w) OVER ()::BIGINT AS w_all
  FROM r
  WINDOW before AS (ORDER BY cap / w, source IS NULL, encode(source) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
o AS (
  SELECT *, 150 * size_all - 100 * cap_before AS lft, w_all - w_before AS weight_left,
         (150 * size_all - 100 * cap_before) / (w_all - w_before) <= 100 * cap / w AS open
  FROM c),
level AS (SELECT w_before AS lw, lft, weight_left FROM o WHERE open ORDER BY w_before LIMIT 1),
t AS (
  SELECT source, source_size, CASE WHEN level.lw IS NULL OR w_before < level.lw THEN cap::DOUBLE
                   ELSE (level.lft * w)::DOUBLE / (100 * level.weight_left)::DOUBLE END AS target
  FROM o LEFT JOIN level ON true),
p AS (
  SELECT d.doc_id, d.size, d.source, t.source_size, t.target, round(t.target)::BIGINT AS budget,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (
  SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS whole FROM p)
SELECT doc_id, size, source_size, target, (epochs * size)::BIGINT AS taken, epochs, source FROM (
  SELECT *, least(whole + CASE WHEN 2 * start + size <= 2 * (budget - whole * source_size) THEN 1 ELSE 0 END, 2)::BIGINT AS epochs
  FROM e)""",
    "op10_url_automaton": r"""
WITH u AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
rules(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                          ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
best AS (
  SELECT page_id, host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v
  FROM u LEFT JOIN rules ON (('.' || host) LIKE ('%.' || h) AND starts_with(path, p))
  GROUP BY ALL)
SELECT page_id, host, path, rule,
       coalesce(v, CASE WHEN regexp_matches('.' || host || path, '^[^/]*[.](casino-|adult-|free-bets[.]|spam-)[^/]*/')
                          OR contains(path, '/wp-login.php') OR contains(path, '/cgi-bin/') THEN 'block' ELSE 'allow' END) AS verdict
FROM best""",
}

_LEDGER_SQL = LLM_ORACLES["op2_rule_ledger"]
LLM_ORACLES["rule_ablations"] = f"""
WITH ledger AS ({_LEDGER_SQL}),
rules(rule, bit) AS (VALUES ('too_few_words', 1), ('repeated_windows', 2), ('symbols', 4), ('shouting', 8), ('repeated_lines', 16),
                            ('stutter', 32)),
policies(policy, mask) AS (VALUES ('base-1', 3), ('corpus-1', 15), ('corpus-2', 63))
SELECT policy, rule, count(*) FILTER (failed_bits & bit <> 0) AS n_fail, count(*) FILTER (failed_bits & mask <> 0) AS n_rejected,
       count(*) FILTER (failed_bits & mask = bit) AS n_only_this
FROM ledger CROSS JOIN policies JOIN rules ON mask & bit <> 0 GROUP BY policy, rule"""
