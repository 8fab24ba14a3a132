"""Bibliographic JSON -> struct."""

import pytest

from lectio.functions.bib import parse_bib_record


def parse(spark, raw):
    df = spark.createDataFrame([(raw,)], "j string")
    return df.select(parse_bib_record("j").alias("r")).first().r


@pytest.mark.parametrize("raw", [None, "", "{bad", "[1, 2]", '"text"'])
def test_empty_records(spark, raw):
    r = parse(spark, raw)
    assert r.ol_key is None and r.number_of_pages is None and r.cover_url is None
    assert r.subjects == [] and r.authors == [] and r.publishers == []


def test_mixed_subjects(spark):
    r = parse(spark, '{"subjects":[{"name":"Fantasy","url":"u"},"bad",{"url":"z"},{"name":5}]}')
    assert r.subjects == ["Fantasy", "5"]


@pytest.mark.parametrize("raw,pages", [
    ('{"number_of_pages":0,"pagination":"9"}', 0),
    ('{"pagination":"416 p."}', 416),
    ('{"pagination":"xii, 416 p."}', 416),
    ('{"pagination":"2 v. (416 p.)"}', 2416),
    ('{"pagination":null}', None),
    ('{"number_of_pages":null,"pagination":"12"}', 12),
    ('{"number_of_pages":321}', 321),
    ('{"pagination":"none"}', None),
])
def test_pages(spark, raw, pages):
    assert parse(spark, raw).number_of_pages == pages


def test_cover_and_scalars(spark):
    r = parse(spark, '{"key":"/books/OL1M","title":"T","publish_date":"1999",'
                     '"authors":[{"name":"A"}],"publishers":[{"name":"P"}],'
                     '"cover":{"large":"","medium":"m","small":"s"}}')
    assert (r.ol_key, r.ol_title, r.publish_date, r.cover_url) == ("/books/OL1M", "T", "1999", "m")
    assert r.authors == ["A"] and r.publishers == ["P"]
