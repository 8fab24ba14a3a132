import datetime as dt
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lectio.llm import feistel as P
from lectio.llm import queries as Q
from lectio.llm import quotations as M
from lectio.llm import url_automaton as U

PRIVATE = ("mail a.b+1@mail3.example.com or Zoë9@x.org, ip 97.51.17.173, card 4845168114407329 and 4845-1681-1440-7329, "
           "call +1 (017) 555-7713 on 2024-02-29, 31/12/1999 12/31/1999 01.02.2003, DE89 3704 0044 0532 0130 00, "
           'token = "b44e15e09fd311c3cf3163b66d5a9875b883d8ce"')
PUBLIC = "order 9807915762804490, version 1.2.3.4.5, 300.1.1.1, 2024-13-01, 30.02.2003, DE88 3704 0044 0532 0130 00, 12345"


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000])
def test_feistel_is_a_keyed_permutation(n):
    one, two = P.Feistel(b"one"), P.Feistel(b"two")
    image = [one.permute("t", n, i) for i in range(n)]
    assert sorted(image) == list(range(n))
    assert [one.restore("t", n, y) for y in image] == list(range(n))
    assert n < 10 or image != [two.permute("t", n, i) for i in range(n)]


def test_values_keep_their_format_and_come_back():
    change, undo = P.Pseudonymiser(b"k"), P.Pseudonymiser(b"k", back=True)
    new, found = change.replace(PRIVATE)
    assert found == Counter(card=2, email=2, date=4, ipv4=1, phone=1, iban=1, secret=1)
    for value in ("4845168114407329", "97.51.17.173", "555-7713", "2024-02-29", "b44e15e0", "0532 0130", "a.b+1@"):
        assert value not in new
    cards = re.findall(r"\d{16}|\d{4}(?:-\d{4}){3}", new)
    assert cards[0] == cards[1].replace("-", "") and P.luhn_digit(cards[0][:-1]) == cards[0][-1]  # linked and valid
    iban = re.search(r"DE\d\d(?: \d{4}){4} \d\d", new)[0].replace(" ", "")
    assert P.iban_digits("DE", iban[4:]) == iban[2:4]
    dt.date.fromisoformat(re.search(r"\d{4}-\d\d-\d\d", new)[0])
    assert undo.replace(new) == (PRIVATE, found)
    assert change.replace(PUBLIC) == (PUBLIC, Counter())


@pytest.mark.parametrize("text, kind", [
    ("4111 1111 1111 1111 123", "card"), ("4111111111111111 05/27", "card"), ("7 4111111111111111", "card"),
    ("AT61 1904 3002 3457 3201 USD", "iban")])
def test_values_beside_a_short_group(text, kind):
    for key in range(60):  # some pseudonyms are valid together with the neighbour
        change, undo = P.Pseudonymiser(b"%d" % key), P.Pseudonymiser(b"%d" % key, back=True)
        new, found = change.replace(text)
        assert found == Counter({kind: 1}) and new != text and len(new) == len(text)
        assert undo.replace(new) == (text, found)


def test_equal_dates_and_phones_stay_linked():
    change, undo = P.Pseudonymiser(b"k"), P.Pseudonymiser(b"k", back=True)
    for day in ("1999-12-31", "2024-02-29", "2001-03-04", "2010-11-12"):
        y, m, d = day.split("-")
        layouts = [day, f"{y}/{m}/{d}", f"{d}.{m}.{y}", f"{d}/{m}/{y}"] + ([f"{m}/{d}/{y}"] if int(d) > 12 else [])
        new = [change.replace(t)[0] for t in layouts]
        ny, nm, nd = new[0].split("-")
        assert new == [new[0], f"{ny}/{nm}/{nd}", f"{nd}.{nm}.{ny}", f"{nd}/{nm}/{ny}"] + ([f"{nm}/{nd}/{ny}"] if int(d) > 12 else [])
        assert [undo.replace(t)[0] for t in new] == layouts and new[0] != day
    phones = ["(415) 555-2671", "415-555-2671", "1-415-555-2671", "+1 415.555.2671", "+14155552671"]
    new = [change.replace(t)[0] for t in phones]
    assert len({re.sub(r"\D", "", t)[-10:] for t in new}) == 1 and new[0] != phones[0]
    national = re.sub(r"\D", "", new[0])
    assert national[0] in "23456789" and national[3] in "23456789"
    assert [undo.replace(t)[0] for t in new] == phones


@pytest.mark.parametrize("text, kind", [
    ("+44 20 7946 0958", "phone"), ("call +49 (30) 1234567 now", "phone"), ("+352 621 123456", "phone"), ("+44 20 7946 0958 20230112", "phone"),
    ("RO49 AAAA 1B31 0075 9384 0000", "iban"), ("MT84MALT011000012345MTLCAST001S", "iban")])
def test_international_values(text, kind):
    change, undo = P.Pseudonymiser(b"k"), P.Pseudonymiser(b"k", back=True)
    new, found = change.replace(text)
    assert found == Counter({kind: 1}) and new != text and undo.replace(new) == (text, found)


#: What an independent finder takes for a value: plain tests of a whole
#: substring, with no pattern of the operator.
def is_value(t):
    digits = [int(c) for c in t if c.isdigit()]
    other = {c for c in t if not c.isdigit()}
    if t[0].isdigit() and t[-1].isdigit() and other <= {" ", "-"} and 13 <= len(digits) <= 19 and not any(
            not a.isdigit() and not b.isdigit() for a, b in zip(t, t[1:])):
        doubled = [sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(reversed(digits))]
        if sum(doubled) % 10 == 0 and any(digits):
            return "card"
    parts = t.split(".")
    if len(parts) == 4 and all(p.isdigit() and len(p) <= 3 and int(p) < 256 for p in parts):
        return "ipv4"
    for sep in "-/.":
        parts = t.split(sep)
        if len(parts) == 3 and all(p.isdigit() for p in parts):
            sizes = tuple(map(len, parts))
            orders = {(4, 2, 2): [(0, 1, 2)] if sep in "-/" else [], (2, 2, 4): {"/": [(2, 1, 0), (2, 0, 1)], ".": [(2, 1, 0)], "-": []}[sep]}
            for order in orders.get(sizes, []):
                y, m, d = (int(parts[i]) for i in order)
                if 1900 <= y <= 2099 and 1 <= m <= 12 and 1 <= d <= 31:
                    try:
                        dt.date(y, m, d)
                        return "date"
                    except ValueError:
                        pass
    if t.startswith("+44 ") and other == {"+", " "} and 8 <= len(digits) <= 15 and t[4] not in " 0" and "  " not in t and all(
            len(g) > 1 for g in t[1:].split(" ")) and len(digits) >= 8 and t[-1].isdigit():
        return "phone"
    if len(t) in (32, 40, 64) and (all(c in "0123456789abcdef" for c in t) or all(c in "0123456789ABCDEF" for c in t)):
        return "secret"
    return None


def spans(text):
    """Every substring that stands free and is a value; leftmost, longest."""
    out, at = [], 0
    while at < len(text):
        for end in range(len(text), at, -1):
            if (at == 0 or text[at - 1] == " ") and (end == len(text) or text[end] in " ,") and text[at] != " " and (kind := is_value(text[at:end])):
                out.append((at, end, kind))
                at = end
                break
        else:
            at += 1
    return out


def test_against_a_finder_of_every_substring():
    rnd = random.Random(17)

    def number(n):
        return "".join(rnd.choice("0123456789") for _ in range(n))

    def card():
        body = number(15)
        return body + (P.luhn_digit(body) if rnd.random() < 0.6 else number(1))

    makers = [card, lambda: " ".join(re.findall("....", card())), lambda: "-".join(re.findall("....", card())),
              lambda: ".".join(str(rnd.randrange(300)) for _ in range(4)),
              lambda: f"{rnd.randrange(1890, 2110)}-{rnd.randrange(14):02d}-{rnd.randrange(33):02d}",
              lambda: f"{rnd.randrange(33):02d}/{rnd.randrange(33):02d}/{rnd.randrange(1890, 2110)}",
              lambda: f"{rnd.randrange(33):02d}.{rnd.randrange(14):02d}.{rnd.randrange(1890, 2110)}",
              lambda: f"+44 {number(2)} {number(4)} {number(4)}", lambda: "".join(rnd.choice("0123456789abcdef") for _ in range(rnd.choice([31, 32, 40]))),
              lambda: number(rnd.randrange(1, 9))]
    some = Counter()
    for _ in range(700):
        text = " ".join(f"{rnd.choice(['the', 'at', 'von'])} {rnd.choice(makers)()}{rnd.choice(['', ',', ' end'])}" for _ in range(rnd.randrange(1, 5)))
        found = spans(text)
        new, counts = P.Pseudonymiser(b"k").replace(text)
        assert counts == Counter(kind for _, _, kind in found), text
        edges = [0, *(x for begin, end, _ in found for x in (begin, end)), len(text)]
        outside = [re.escape(text[i:j]) for i, j in zip(edges[::2], edges[1::2])]
        assert re.fullmatch(r"(\S.*?)".join(outside), new) and not any(text[i:j] in new for i, j, kind in found if kind != "date")
        assert P.Pseudonymiser(b"k", back=True).replace(new)[0] == text
        some.update(counts)
    assert set(some) == {"card", "ipv4", "date", "phone", "secret"} and min(some.values()) > 20


def test_pseudonymise(spark, odd_docs, no_docs):
    got = P.pseudonymise(odd_docs, b"k")
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter((r.doc_id, r.text) for r in odd_docs.collect())
    assert P.pseudonymise(no_docs, b"k").count() == 0
    df = spark.createDataFrame([(1, PRIVATE), (2, PRIVATE + " " + PUBLIC), (2, None)], "doc_id long, text string")
    new = P.pseudonymise(df, b"k")
    rows = {r.doc_id: r for r in new.where("text is not null").collect()}
    assert rows[2].text == rows[1].text + " " + PUBLIC and rows[1].n_replaced == 12 and rows[1].n_card == 2
    back = P.pseudonymise(new.select("doc_id", "text"), b"k", back=True)
    assert sorted(r.text or "" for r in back.collect()) == sorted(r.text or "" for r in df.collect())


def glob_regex(glob):
    out = ""
    for part in re.findall(r"\*\*|\*|\?|.", glob, re.S):
        out += {"**": "(?s:.*)", "*": "[^/]*", "?": "[^/]"}.get(part, re.escape(part))
    return re.compile(out + r"\Z")


def test_automaton_against_regular_expressions():
    rnd = random.Random(6)
    globs = ["", "*", "**", "a", "?b*", "**a?b**", "*.a/**", "*.b.a/c**", "a**b*c", "é*/?", "/**/", "***", "*?*", "a/?"]
    globs += ["".join(rnd.choice(["a", "b", "/", ".", "*", "**", "?"]) for _ in range(rnd.randrange(8))) for _ in range(60)]
    automaton = U.WildcardAutomaton(globs)
    assert automaton.n_bits > 64  # several words
    compiled = [glob_regex(g) for g in globs]
    for _ in range(3000):
        text = "".join(rnd.choice("aab/.cé") for _ in range(rnd.randrange(9)))
        assert automaton.matches(text) == [i for i, c in enumerate(compiled) if c.match(text)], text


def test_judge_urls(spark, odd_pages, no_pages):
    cases = {
        "https://m.Example.ORG/es/1": ("m.example.org", "/es/1", "example.org/es/", "block"),
        "http://example.org/en/19?q": ("example.org", "/en/19", "example.org/en/1", "block"),
        "http://badexample.org/es/1": ("badexample.org", "/es/1", "org/", "allow"),
        "http://x.com/fr/": ("x.com", "/fr/", "com/fr/", "allow"),
        "http://x.com/de/#top": ("x.com", "/de/", "com/de/", "block"),
        "http://x.com/y.org/": ("x.com", "/y.org/", None, "allow"),
        "http://x.org": ("x.org", "", None, "allow"),
        "http://m.casino-win.example.net/": ("m.casino-win.example.net", "/", None, "block"),
        "no scheme/": ("", "", None, "allow"), "": ("", "", None, "allow"), None: ("", "", None, "allow"),
        "a://b://c.org/x": ("b:", "//c.org/x", None, "allow"), "http://l.net/" + "a" * 100_000: ("l.net", "/" + "a" * 100_000, None, "allow"),
    }
    df = spark.createDataFrame(list(enumerate(cases)), "page_id long, url string")
    got = {r.page_id: tuple(r)[1:5] for r in U.judge_urls(df, Q.URL_RULES).collect()}
    assert [got[i] for i in range(len(cases))] == list(cases.values())
    assert U.judge_urls(odd_pages, Q.URL_RULES).count() == odd_pages.count()
    assert U.judge_urls(no_pages, Q.URL_RULES).count() == 0


def test_quote_levels_and_own_text():
    text = "Hello\n\nOn Monday, Ann wrote:\n> First  line\n> second\n>\n> Bob wrote:\n> > Deep\n>> deeper\n\nMy answer\nis no > yes"
    own, passages = M.parse_message(text)
    assert own == "Hello\n\nMy answer\nis no > yes"
    assert [(level, words) for level, _, words in passages] == [
        (0, "hello"), (1, "first line second"), (2, "deep deeper"), (0, "my answer is no > yes")]
    assert M.parse_message(None) == ("", []) and M.parse_message("") == ("", [])
    assert M.parse_message("> " * 3000 + "x")[1] == [(3000, 0, "x")]


MAIL = [
    (1, 0, "What is this?\n\nSecond part"), (1, 1, "An answer\n\nOn day 0, A wrote:\n> what IS   this?"),
    (1, 2, "Indeed\n> An answer\n>> What is this?"), (1, 3, "To the second\n> Second part"), (1, 4, "New topic"),
    (1, 5, "> said nowhere\nHm"), (2, 0, "> What is this?\nForwarded"), (2, 1, None), (None, 0, "> Indeed\nlost"), (3, None, "x"),
    (2, 2, "> What is this?"), (2, 2, "> Forwarded"),
]


def test_reply_order(spark):
    df = spark.createDataFrame(MAIL, "conv_id long, turn long, text string")
    df = df.withColumns({c: F.lit("clash") for c in ("conv", "row", "own", "passages", "hash", "up", "role")})
    rows = M.reply_order(df).collect()
    got = {(r.conv_id, r.turn, r.own_text): (r.parent_turn, r.root_turn, r.depth, r.n_quotes, r.n_linked) for r in rows}
    assert len(rows) == len(MAIL)
    assert got[1, 0, "What is this?\n\nSecond part"] == (None, 0, 0, 0, 0)
    assert got[1, 1, "An answer"] == (0, 0, 1, 1, 1)
    assert got[1, 2, "Indeed"] == (1, 0, 2, 2, 2)
    assert got[1, 3, "To the second"] == (0, 0, 1, 1, 1)
    assert got[1, 5, "Hm"] == (None, 5, 0, 1, 0)
    assert got[2, 0, "Forwarded"] == (None, 0, 0, 1, 1)  # linked to another conversation: no reply in this one
    assert got[2, 1, ""] == (None, 1, 0, 0, 0)
    assert got[2, 2, ""] == (0, 0, 1, 1, 1) and got[None, 0, "lost"][4] == 1
    links = {(r.conv, r.turn, r.level, r.place): (r.from_conv, r.from_turn) for r in M.link_quotes(M.parse_messages(df)).collect()}
    assert links[2, 0, 1, 0] == (1, 0) and links[1, 2, 2, 2] == (1, 0) and links[1, 5, 1, 0] == (None, None)
    assert M.reply_order(df.where("false")).count() == 0


def test_trimmed_and_interleaved_quotes(spark):
    rows = [(1, 0, "Hello all\nThe first line of it\nand then a second line\nand last a third line"),
            (1, 1, "Short words here\n> and then a second line\nMy answer to that"),  # trimmed
            (1, 2, "> The first line of it\nYes it is so\n> AND last  a third line\nNo it is not"),  # interleaved
            (1, 3, "> Yes it is so\n>> Hello all\nAgreed then, all of it"),  # a line of message 2; a line too short to link
            (1, 4, "> nobody ever said this\nWhat"), (2, 0, "> My answer to that\nfrom another conversation"),
            (1, 5, "> My answer to that\n> and more that was added\nWell"), (None, 1, "> My answer to that\nx"), (1, None, "> Yes it is so")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string")
    got = {(r.conv_id, r.turn): (r.parent_turn, r.n_quotes, r.n_linked) for r in M.reply_order(df).collect()}
    assert got[1, 0] == (None, 0, 0) and got[1, 1] == (0, 1, 1) and got[1, 2] == (0, 2, 2)
    assert got[1, 3] == (2, 2, 1) and got[1, 4] == (None, 1, 0) and got[1, 5] == (1, 1, 1)
    assert got[2, 0] == (None, 1, 1) and got[None, 1] == (None, 1, 1)  # said whole, but in another conversation


def test_long_threads(spark):
    n = 70
    rows = [(1, i, f"message {i}" + (f"\n> message {i - 1}" if i else "")) for i in range(n)]
    got = M.reply_order(spark.createDataFrame(rows, "conv_id long, turn long, text string")).collect()
    assert sorted((r.turn, r.depth, r.root_turn) for r in got) == [(i, i, 0) for i in range(n)]
