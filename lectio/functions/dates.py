"""Free-form date text -> DATE.

Covers the feeds' RFC-822 stamps (``Sun, 29 Mar 2026 22:30:00 -0700``), page
timelines (``March 29, 2026``), C-library stamps (``Sun Mar 29 22:30:00 PDT
2026``), spoken ones (``29th of March 2026``) and numeric dates with either
end first and two- or four-digit years. The leftmost date in the text counts;
digits that touch it make it no date, and a clock time is never taken for a
day or a year. The wall-clock date is returned; the offset is ignored and no
timestamp is ever built, so ``22:30 -0700`` stays on the 29th. Empty, NULL,
unparseable and partial dates give NULL (never an error).

One pass over the text: a single alternation with named parts finds the date
and hands on year, month and day; the rest works on these three.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectio.functions.text import once

# Month names; the first three letters tell them apart.
_NAME = ("(?:Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|June?|July?|Aug(?:ust)?|Sept?(?:ember)?|Oct(?:ober)?"
         "|Nov(?:ember)?|Dec(?:ember)?)")
_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
_SEP = r"[ ,./-]{1,2}"
_ZONE = r"(?: (?:[A-Z]{2,5}|[+-]\d{2}:?\d{2})){0,2}"

# The layouts, tried at the same place of the text in this
# order. <y> is a year of four digits, <yy> of four or two; <name> and <m>
# are months, <d> is a day.
DATE_LAYOUTS = [
    rf"(?<![\d.,/:-])<d>(?:{_SEP}| of )<name>{_SEP}<yy>(?![\d:])",
    rf"\b<name>{_SEP}<d>{_SEP}(?:\d{{1,2}}:\d{{2}}(?::\d{{2}})?{_ZONE} )?<y>(?!\d)",
    rf"(?<![\d+-])<y>{_SEP}<name>{_SEP}<d>(?![\d:])",
    r"(?<!\d)<y>-<m>-<d>(?!\d)",
    r"(?<!\d)<y>[/.]<m>[/.]<d>(?!\d)",
    r"(?<![\d/.:-])<m>[/.-]<d>[/.-]<yy>(?!\d)",
    r"(?<!\d)(?<y>\d{4})(?<m>\d{2})(?<d>\d{2})(?!\d)",
]
_PARTS = {"name": _NAME, "y": r"\d{4}", "yy": r"(?:\d{4}|\d{2})", "m": r"\d{1,2}", "d": r"\d{1,2}"}
_MARK = "\x01"


def _compiled() -> tuple[str, str]:
    """The alternation with groups numbered by layout, and a replacement that
    writes the parts of whichever layout matched: year|name|month|day."""
    layouts, groups = [], {"y": "", "name": "", "m": "", "d": ""}
    for n, layout in enumerate(DATE_LAYOUTS):
        for part, text in _PARTS.items():
            group = "y" if part == "yy" else part
            if f"(?<{part}>" in layout or f"<{part}>" in layout:
                groups[group] += f"${{{group}{n}}}"
            layout = layout.replace(f"(?<{part}>", f"(?<{group}{n}>")
            ordinal = "(?:st|nd|rd|th)?" if part == "d" and "<name>" in DATE_LAYOUTS[n] else ""
            layout = layout.replace(f"<{part}>", f"(?<{group}{n}>{text}){ordinal}")
        layouts.append(layout)
    return r"(?is)^.*?(?:" + "|".join(layouts) + r").*$", _MARK + "|".join(groups[g] for g in ("y", "name", "m", "d"))


_PATTERN, _REPLACEMENT = _compiled()


def _date(parts: Column) -> Column:
    year, name, number, day = (F.get(parts, F.lit(i)) for i in range(4))
    month = F.when(name != "", F.floor((F.position(F.lower(F.left(name, F.lit(3))), F.lit(_MONTHS)) + 2) / 3).cast("int")).otherwise(
        number.try_cast("int"))
    century = F.lit(2000) + year.try_cast("int")
    year = (F.when(F.length(year) == 2, F.when(century >= F.year(F.current_date()) + 50, century - 100).otherwise(century).cast("string"))
            .when(year != "0000", year))
    # month first, and day first where that is no date
    swapped = month > 12
    return F.concat_ws("-", F.coalesce(year, F.lit("no")), F.when(swapped, day).otherwise(month.cast("string")),
                       F.when(swapped, month.cast("string")).otherwise(day)).try_cast("date")


def parse_flexible_date(c: Column | str) -> Column:
    """DATE from free text, NULL when no layout matches.

    Month-first is preferred for numeric dates and day-first is tried when
    that is not a valid date ("29/03/2026"), as a free-form parser does.
    Two-digit years are the nearest ones below 50 years from today. The
    input is referenced once."""
    c = F.col(c) if isinstance(c, str) else c
    found = F.regexp_replace(c, _PATTERN, _REPLACEMENT)
    return once(found, lambda f: F.when(F.startswith(f, F.lit(_MARK)), once(F.split(F.substring(f, 2, 2**31 - 1), r"\|"), _date)))
