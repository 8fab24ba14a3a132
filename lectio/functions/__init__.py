"""Native column expressions replacing per-row Python parsers.
All of them stay inside the JVM (no Python worker round trip)."""

from lectio.functions.bib import parse_bib_record
from lectio.functions.dates import parse_flexible_date
from lectio.functions.html import decode_entities, extract_labelled
from lectio.functions.text import bullet_list, decode_json_array, quote_url

__all__ = [
    "parse_bib_record", "parse_flexible_date", "decode_entities", "extract_labelled",
    "bullet_list", "decode_json_array", "quote_url",
]
