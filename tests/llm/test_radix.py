import hashlib
import random
import string
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from lectio.llm import radix_dedup as R

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def check(rows, got):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    assert len(got) == len(rows)
    want = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        for i in ids:
            want[i, keep, len(ids), sha] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) <= {1} and len(kept) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_odd_rows(odd_docs, no_docs):
    check([(r.doc_id, r.text) for r in odd_docs.collect()], R.equal_text_groups(odd_docs).collect())
    assert R.equal_text_groups(no_docs).count() == 0


def test_random_prefixes_against_grouping(spark):
    rnd = random.Random(7)
    base = "".join(rnd.choice("ab") for _ in range(900))
    texts = [base[:rnd.choice([0, 1, 3, 4, 5, 20, 36, 63, 64, 65, 300, 900])] + rnd.choice(["", "", "x", "é", "ab" * 9]) for _ in range(400)]
    rows = [(rnd.randrange(300), t) for t in texts]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(rows, R.equal_text_groups(df, first=4, growth=8).collect())


def test_drop_copies(odd_docs, no_docs):
    kept = R.drop_copies(odd_docs)
    assert kept.schema == odd_docs.schema
    rows = kept.collect()
    texts = [(r.text or "").translate(LOWER) for r in rows]
    assert len(texts) == len(set(texts)) == len({(r.text or "").translate(LOWER) for r in odd_docs.collect()})
    assert R.drop_copies(no_docs).count() == 0


def test_string_ids(spark):
    df = spark.createDataFrame([("b", "same text here"), ("a", "same text here"), ("c", "other")], "k string, body string")
    got = {r.k: (r.keep_id, r.kept) for r in R.equal_text_groups(df, "k", "body").collect()}
    assert got == {"a": ("b", False), "b": ("b", True), "c": ("c", True)}


def test_one_copy_of_repeated_rows_stays_with_all_columns(spark):
    rows = [(1, "Same", "a"), (1, "Same", "a"), (1, "same", "b"), (None, "SAME", "c"), (2, None, "d"), (None, "", "e"), (None, "x" * 5000, "f"),
            (None, "X" * 5000, "g"), (3, "x" * 5001, "h")]
    got = R.drop_copies(spark.createDataFrame(rows, "doc_id long, text string, `o.dd` string")).collect()
    assert sorted((r.text or "").lower() for r in got) == sorted({(t or "").lower() for _, t, _ in rows})
    assert {r.doc_id for r in got if r.text and len(r.text) < 9} == {1} and {r["o.dd"] for r in got} >= {"d", "h"}


def test_only_merge_joins_whatever_the_size(spark):
    """Documents learn their group by the same join at every size, whose
    sides have exchanges of their own: a hot first digit can be split."""
    df = spark.range(50).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"))
    assert {r.group_size for r in R.equal_text_groups(df).collect()} == {50}
    rows = spark.createDataFrame([(i, i, 0, "same") for i in range(50)], "id long, row long, group long, text string")
    plan = R._split(rows, F.col("text"), 0, 0, 64, "test")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 1 and "Broadcast" not in plan and plan.count("Exchange hashpartitioning") == 2
