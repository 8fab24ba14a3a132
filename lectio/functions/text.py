"""Small string helpers shared by several operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def bullet_list(titles: Column, bullet: str = "• ", sep: str = "<br>") -> Column:
    """Title list -> one label string ``• a<br>• b``."""
    return F.array_join(F.transform(titles, lambda t: F.concat(F.lit(bullet), t)), sep)


def decode_json_array(c: Column) -> Column:
    """JSON text of a string array -> array<string>; empty/NULL -> []."""
    return F.coalesce(F.from_json(F.nullif(c, F.lit("")), "array<string>"),
                      F.array().cast("array<string>"))


# Characters left unescaped in lookup URLs.
URL_SAFE = [("%2C", ","), ("%3A", ":"), ("%2F", "/")]


def quote_url(c: Column) -> Column:
    """Percent-encode like a path quote with ``,:/`` kept literal: form
    encoding is adjusted so space is %20, '*' is %2A and '~' stays."""
    out = F.url_encode(c)
    for enc, ch in URL_SAFE:
        out = F.replace(out, F.lit(enc), F.lit(ch))
    out = F.replace(out, F.lit("+"), F.lit("%20"))
    out = F.replace(out, F.lit("*"), F.lit("%2A"))
    return F.replace(out, F.lit("%7E"), F.lit("~"))


def once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once however often it is used:
    bound as a lambda variable, which also keeps the generated code small."""
    return F.element_at(F.transform(F.array(value), use), 1)
