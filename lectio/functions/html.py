"""Labelled-element extraction from raw HTML without a DOM parser.

Semantics: take every ``<div>`` whose class list contains ``css_class``;
keep those whose text contains both ``label`` and ``sep``; of those take the
last; return its text (tag boundaries become one space, entities decoded)
before the first ``sep``, stripped. NULL for NULL/empty HTML or no match.

The label test runs on the text with tags removed and nothing inserted,
the returned text on the space-joined form, like a DOM ``get_text`` with and
without a separator.

Elements end where a tree builder ends them, at any depth: the tags are
listed once in order, and one fold over the list keeps the open elements. A
closing tag closes the innermost open element of its name and all that is
open inside it, so an unclosed element ends with its parent; a closing tag
without an opening one is ignored; what is open at the end of the page ends
there.
"""

from __future__ import annotations

import html.entities

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectio.functions.text import once

_STRIP = r"(?U)^\s+|\s+$"

# Markup a DOM parser never treats as elements: comments and the raw text
# of script / style elements.
_NOT_MARKUP = r"(?is)<!--.*?-->|<(script|style)\b[^>]*>.*?</\1\s*>"

# The rest of a tag: values in quotes may hold ">".
_REST = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))*+>"""
_TAG = r"</?[a-zA-Z!]" + _REST
#: A tag and the text behind it, up to the next tag.
_TOKEN = r"<[/!?]?[a-zA-Z]" + _REST + r"[^<]*+(?:<(?![a-zA-Z/!?])[^<]*+)*+"
_NAME = r"^<([/!?]?[a-zA-Z][^\s/>]*)"
# Elements without content.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")

# The names that most pages use.
USUAL = ("amp", "ndash", "mdash", "nbsp", "quot", "lt", "gt", "apos", "rsquo", "lsquo", "rdquo", "ldquo", "hellip", "copy")
_ENTITY = r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]*);?"


def _named_entities() -> Column:
    """Map literal of every named character of HTML, from the standard
    library: folded once when the query is planned. A lookup goes through the
    names in order, so the usual ones come first."""
    pairs = {k: html.entities.html5[k + ";"] for k in USUAL} | {k.rstrip(";"): v for k, v in html.entities.html5.items()}
    return F.expr("map(" + ", ".join("'{}', '{}'".format(k, "".join(f"\\U{ord(c):08x}" for c in v)) for k, v in pairs.items()) + ")")


def _decoded(known: Column):
    def one(entity: Column) -> Column:
        """The character of ``&name;`` or ``&#n;``; an unknown name stays."""
        def of(name: Column) -> Column:
            digits = F.when(F.lower(F.left(name, F.lit(2))) == "#x", F.conv(F.substring(name, 3, 8), 16, 10)).otherwise(F.substring(name, 2, 8))
            return F.when(F.startswith(name, F.lit("#")), once(digits.try_cast("int"), _character)).otherwise(
                F.coalesce(F.try_element_at(known, name), entity))

        return once(F.regexp_extract(entity, _ENTITY, 1), of)

    return one


def _character(code: Column) -> Column:
    valid = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    return F.decode(F.unhex(F.lpad(F.hex(F.when(valid, code).otherwise(0xFFFD)), 8, "0")), "UTF-32")


def decode_entities(c: Column) -> Column:
    """Named and numeric entities replaced by their characters in one go, so
    nothing is decoded twice; text without ``&`` is returned as is."""
    def decoded(text: Column) -> Column:
        between, found = F.split(text, _ENTITY, -1), F.regexp_extract_all(text, F.lit(_ENTITY), F.lit(0))
        pairs = F.zip_with(between, F.transform(found, _decoded(_named_entities())),
                           lambda part, char: F.concat(part, F.coalesce(char, F.lit(""))))
        return F.when(F.contains(text, F.lit("&")), F.array_join(pairs, "")).otherwise(text)

    return once(c, decoded)


def _java_quote(s: str) -> str:
    return "\\Q" + s + "\\E"


def visible_markup(html: Column) -> Column:
    """``html`` without comments and script/style bodies, for which a tag
    without meaning stands; the rewrite only runs on pages that contain one
    of them."""
    has = (F.contains(html, F.lit("<!--")) | F.lower(html).contains("<script")
           | F.lower(html).contains("<style"))
    return F.when(has, F.regexp_replace(html, _NOT_MARKUP, "<!x>")).otherwise(html)


def _opens(css_class: str, tag: str) -> str:
    """Pattern of an opening ``tag`` whose class attribute, quoted or not,
    holds ``css_class`` as a whole word."""
    cls = _java_quote(css_class)
    other = r"""(?:\s+(?!class\b)[^\s=>"'/]+(?:\s*=\s*(?:"[^"]*+"|'[^']*+'|[^\s"'>]++))?)*+"""
    own = (rf"""(?:"(?:[^"]*\s)?{cls}(?:\s[^"]*)?"|'(?:[^']*\s)?{cls}(?:\s[^']*)?'|{cls}(?=[\s/>]))""")
    return rf"(?is)<{tag}\b{other}\s+class\s*=\s*{own}{_REST}"


_SPANS = "array<struct<from:int,to:int>>"
_OPEN = "array<struct<size:int,from:int>>"


def _read(token: Column) -> Column:
    """Name of the tag a token begins with, ``/name`` for a closing one, and
    nothing for a tag without content."""
    # what a tag can't be without is looked for first, it is cheaper than the pattern
    alone = F.contains(token, F.lit("/>")) & F.rlike(token, F.lit(rf"^<[a-zA-Z]{_REST[:-1]}(?<=/)>"))
    return once(F.lower(F.regexp_extract(token, _NAME, 1)),
                lambda name: F.when(name.isin(*VOID) | F.startswith(name, F.lit("!")) | F.startswith(name, F.lit("?")) | alone,
                                    F.lit("")).otherwise(name))


def _spans(tokens: Column, css_class: str, tag: str) -> Column:
    """array<struct<from, to>> of token positions: where each ``tag`` of the
    class begins and ends, in order of beginning.

    The open elements are one string, innermost first; an element is open as
    long as the string is not shorter than when it was opened. Outside the
    wanted elements nothing needs to be kept, unless one of them is closed by
    the end of a parent that began before it: then (``odd``) the page is
    folded again with all its elements."""
    wanted = r"\A" + _opens(css_class, tag)

    def fold(whole: bool) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.lit("/").alias("stack"), F.array().cast(_OPEN).alias("open"),
                         F.array().cast(_SPANS).alias("done"), F.lit(False).alias("odd"))

        def step(state: Column, token: Column) -> Column:
            is_wanted = F.contains(token, F.lit(css_class)) & F.rlike(token, F.lit(wanted))
            idle = F.lit(False) if whole else (F.size(state["open"]) == 0) & ~F.contains(token, F.lit(css_class))
            rest = F.struct((state["at"] + 1).alias("at"), F.lit("/").alias("stack"), state["open"].alias("open"),
                            state["done"].alias("done"), state["odd"].alias("odd"))
            return F.when(idle, rest).otherwise(once(_read(token), lambda name: named(state, name, is_wanted)))

        def named(state: Column, name: Column, is_wanted: Column) -> Column:
            stack, closing = state["stack"], F.startswith(name, F.lit("/"))
            place = F.when(closing, F.position(F.concat(name, F.lit("/")), stack))
            after = F.when(name == "", stack).when(closing, once(
                place, lambda p: F.when(p > 0, F.substr(stack, p + F.length(name))).otherwise(stack))).otherwise(
                F.concat(F.lit("/"), name, stack))
            return once(after, lambda now: moved(state, name, closing, is_wanted, now))

        def moved(state: Column, name: Column, closing: Column, is_wanted: Column, stack: Column) -> Column:
            size, at, open_ = F.length(stack), state["at"], state["open"]
            ends = closing & (F.size(open_) > 0)
            opened = (F.when(ends, F.filter(open_, lambda e: e["size"] <= size))
                      .when(~closing & (name != "") & is_wanted, F.concat(open_, F.array(F.struct(size.alias("size"), at.alias("from")))))
                      .otherwise(open_))
            done = F.when(ends, F.concat(state["done"], F.transform(F.filter(open_, lambda e: e["size"] > size),
                                                                    lambda e: F.struct(e["from"].alias("from"), at.alias("to")))))
            odd = state["odd"] | (ends & (size == F.length(state["stack"])))
            return F.struct((at + 1).alias("at"), stack.alias("stack"), opened.alias("open"),
                            F.coalesce(done, state["done"]).alias("done"), odd.alias("odd"))

        return F.aggregate(tokens, start, step)

    def finish(state: Column) -> Column:
        cut = F.transform(state["open"], lambda e: F.struct(e["from"].alias("from"), state["at"].alias("to")))
        return F.when(F.size(state["open"]) > 0, F.array_sort(F.concat(state["done"], cut))).otherwise(F.array_sort(state["done"]))

    return once(fold(whole=False), lambda s: F.when(s["odd"], once(fold(whole=True), finish)).otherwise(finish(s)))


def _plain_elements(css_class: str, tag: str) -> str:
    """Pattern of a wanted element that holds text, elements without content
    and inline elements with nothing but text: group 1 is what it holds. Such
    an element ends at its closing tag whatever stands around it."""
    void = rf"<(?:{'|'.join(VOID)})\b{_REST}"
    inline = rf"<(?!{tag}\b|(?:{'|'.join(VOID)})\b)([a-zA-Z][a-zA-Z0-9]*)(?:\s{_REST}|>)[^<]*+</\2\s*>"
    return rf"{_opens(css_class, tag)}((?:[^<]++|<(?![a-zA-Z/!?])|{void}|{inline})*+)</{tag}\s*>"


def element_texts(html: Column, css_class: str, tag: str = "div") -> Column:
    """array<string> of the inner HTML of every ``tag`` whose class list
    holds ``css_class``, in order; nested ones too, whatever their depth.

    Where all of a page's wanted elements are plain, two patterns find them;
    only the others are folded tag by tag. Both give the same."""
    def cut(tokens: Column) -> Column:
        def text(s: Column) -> Column:
            return F.array_join(F.slice(tokens, s["from"] + 1, s["to"] - s["from"]), "")

        return F.transform(_spans(tokens, css_class, tag), text)

    def of(page: Column) -> Column:
        plain = F.regexp_extract_all(page, F.lit(_plain_elements(css_class, tag)), F.lit(1))
        wanted = F.regexp_count(page, F.lit(_opens(css_class, tag)))
        tokens = F.regexp_extract_all(page, F.lit("(?s)" + _TOKEN), F.lit(0))
        return once(plain, lambda found: F.when(F.size(found) == wanted, found).otherwise(once(tokens, cut)))

    return once(visible_markup(html), of)


def extract_labelled(html: Column | str, css_class: str = "readingTimeline__text",
                     label: str = "Started Reading", sep: str = "–",
                     tag: str = "div") -> Column:
    """Text before ``sep`` of the last ``css_class`` element mentioning
    ``label`` and ``sep``; NULL if there is none.

    Cost control: pages without the class name skip the scan; the label test
    runs on tag-stripped text of each element, and the space-joined text is
    built only for the one element returned."""
    html = F.col(html) if isinstance(html, str) else html
    inner = element_texts(html, css_class, tag)

    def untagged(x: Column, tags: str, by: str) -> Column:
        return decode_entities(F.when(F.contains(x, F.lit("<")), F.regexp_replace(x, tags, by)).otherwise(x))

    def mentions(x: Column) -> Column:
        return once(untagged(x, _TAG, ""), lambda t: F.contains(t, F.lit(label)) & F.contains(t, F.lit(sep)))

    def head(last: Column) -> Column:
        text = F.regexp_replace(untagged(last, rf"(\s*{_TAG}\s*)+", " "), _STRIP, "")
        return F.regexp_replace(F.split_part(text, F.lit(sep), F.lit(1)), _STRIP, "")

    last = F.try_element_at(F.filter(inner, mentions), F.lit(-1))
    return F.when(F.contains(html, F.lit(css_class)), once(last, head))
