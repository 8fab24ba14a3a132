"""Bibliographic JSON record -> typed struct (X3, X3a-c), via VARIANT.

``try_parse_json`` keeps well-formed parts of a mixed-type array where a
``from_json`` schema would null the whole array. NULL, empty and malformed
text give NULL scalars and empty arrays.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def _names(v: Column, path: str) -> Column:
    """``[{name: ...}, ...]`` -> names; non-objects and nameless skipped."""
    items = F.try_variant_get(v, path, "array<variant>")
    names = F.filter(F.transform(items, lambda x: F.try_variant_get(x, "$.name", "string")),
                     lambda n: n.isNotNull())
    return F.coalesce(names, F.array().cast("array<string>"))


def _pages(v: Column) -> Column:
    """number_of_pages when present (JSON null counts as absent), else all
    digits of ``pagination`` concatenated ('2 v. (416 p.)' -> 2416)."""
    present = F.try_variant_get(v, "$.number_of_pages", "variant")
    direct = F.try_variant_get(v, "$.number_of_pages", "int")
    digits = F.regexp_replace(F.try_variant_get(v, "$.pagination", "string"), "[^0-9]", "")
    fallback = F.nullif(digits, F.lit("")).try_cast("int")
    return F.when(present.isNotNull() & ~F.is_variant_null(present), direct).otherwise(fallback)


def _text(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def parse_bib_record(raw: Column | str) -> Column:
    """struct<ol_key, ol_title, subjects, authors, publishers, publish_date,
    number_of_pages int, cover_url> from JSON text."""
    raw = F.col(raw) if isinstance(raw, str) else raw
    v = F.try_parse_json(F.nullif(raw, F.lit("")))
    # first non-empty of large, medium; else small as it is ('' stays '')
    cover = F.coalesce(F.nullif(_text(v, "$.cover.large"), F.lit("")),
                       F.nullif(_text(v, "$.cover.medium"), F.lit("")),
                       _text(v, "$.cover.small"))
    return F.struct(
        _text(v, "$.key").alias("ol_key"),
        _text(v, "$.title").alias("ol_title"),
        _names(v, "$.subjects").alias("subjects"),
        _names(v, "$.authors").alias("authors"),
        _names(v, "$.publishers").alias("publishers"),
        _text(v, "$.publish_date").alias("publish_date"),
        _pages(v).alias("number_of_pages"),
        cover.alias("cover_url"),
    )
