import pytest
from pyspark.sql import types as T

#: documents with extra columns whose names the operators use themselves
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    *(T.StructField(c, T.StringType()) for c in ("id", "row", "kept", "size", "class", "group", "digit", "epoch", "key", "n", "m",
                                                "text_sha256", "text_key", "seq"))])
EXTRA = len(SCHEMA) - 5

LONG = " ".join(f"word{i}" for i in range(30_000))
GOOD = " ".join(f"alpha{i} beta{i * 7 % 113}" for i in range(60))

ROWS = [
    (1, GOOD, "en", "a"), (2, GOOD.upper(), "en", "a"), (3, GOOD + " tail", "en", "b"), (3, GOOD + " tail", "en", "b"),
    (4, None, "en", "a"), (5, "", None, None), (None, GOOD, "en", None), (None, None, None, None), (6, " \n\t ", "en", "c"),
    (7, LONG, "en", "c"), (8, LONG, "en", "c"), (9, "one two", "de", "é"), (9, "other text", "de", "é"),
    (10, "x " * 500, "en", "a"), (11, "ÀÉ ß   <|endoftext|> \U0001f600 it's 12", "fr", "b"),
    (12, GOOD + " ### $$$ ***" * 20, "en", "b"), (13, "THIS!! IS!! LOUD!! " * 4 + "A!! B!! C!! D!! E!! F!!", "en", "z"),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    rows = [(i, t, lang, source, None if t is None else len(t), *["clash"] * EXTRA) for i, t, lang, source in ROWS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                      T.StructField("html", T.StringType()), T.StructField("payload", T.StringType()),
                      T.StructField("digest", T.StringType()), T.StructField("host", T.StringType()),
                      T.StructField("id", T.StringType())])
HTML = "<p>" + "é" * 60 + "</p>"
PAGE_ROWS = [
    (5, "http://a.org/x", HTML), (3, "http://b.org/\r\nX: y", HTML), (9, None, HTML), (9, "u", HTML), (3, "again", HTML),
    (None, "http://n.org/", HTML), (7, "", None), (8, "http://s.org", "short"), (10, "http://s.org", "short"), (11, "x", ""),
    (12, "http://long.org/" + "a" * 50_000, "z" * 3_000_000), (None, None, None),
]


@pytest.fixture(scope="session")
def odd_pages(spark):
    return spark.createDataFrame([(*r, "clash", "clash", "clash", "clash") for r in PAGE_ROWS], PAGES).repartition(3).cache()


@pytest.fixture(scope="session")
def no_pages(spark):
    return spark.createDataFrame([], PAGES)
