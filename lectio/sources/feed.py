"""Feed scan (S1, S2): landed XML feeds -> one row per ``<item>``.

One scan over all landed files (several feeds are one multi-path read, not
a driver-side loop), split by the XML source per file, with a declared
schema. Missing or empty elements become '' (the XML source gives NULL for
an absent element); values are trimmed except ``num_pages``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectio.schemas import FEED_FIELDS, FEED_XML


def scan_feed(spark: SparkSession, paths: str | list[str], row_tag: str = "item") -> DataFrame:
    """Bronze-shaped string columns for every item of every feed file."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    raw = (spark.read.format("xml").option("rowTag", row_tag)
           .option("ignoreSurroundingSpaces", "false").schema(FEED_XML).load(paths))
    return feed_columns(raw)


def feed_columns(raw: DataFrame, *extra: Column | str) -> DataFrame:
    """Parsed ``<item>`` structs -> the 16 bronze string columns, and
    ``extra`` ones."""
    cols = []
    for tag, name in FEED_FIELDS:
        if "/" in tag:
            parent, child = tag.split("/")
            c = F.coalesce(F.col(parent)[child], F.lit(""))
        else:
            c = F.regexp_replace(F.coalesce(F.col(tag), F.lit("")), r"(?U)^\s+|\s+$", "")
        cols.append(c.alias(name))
    return raw.select(*cols, *extra)


def union_feeds(*frames: DataFrame) -> DataFrame:
    """S2 for already-read frames whose columns may differ."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
