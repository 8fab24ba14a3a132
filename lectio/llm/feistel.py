"""Format-preserving pseudonyms for personal numbers, dates and addresses.

Each value found is validated, read as a number within its format's domain,
and sent through a keyed Feistel permutation of exactly that domain, then
written back in the same layout. The permutation is a bijection, so equal
values stay linked across documents, different values stay different, a
pseudonym is again a valid value of its format, and the holder of the key
can turn it back.

The Feistel network works on a mixed radix: a domain of size n is held in
``a * b >= n`` with a and b near the square root, the two halves are in turn
shifted by a keyed hash of the other, and results outside the domain are
sent through again (cycle walking)."""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import re
import struct
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
KINDS = ("card", "phone", "ipv4", "date", "iban", "email", "secret")


class Feistel:
    """Keyed permutations of range(n), one for each (name, n)."""

    def __init__(self, key: bytes, memory: int = 200_000):
        self.key = hashlib.blake2b(key, digest_size=32).digest()
        self.memory, self.known = memory, {}

    def _round(self, tweak: bytes, i: int, half: int) -> int:
        body = half.to_bytes((half.bit_length() + 7) // 8 or 1, "big")
        h = hashlib.blake2b(struct.pack(">B", i) + tweak + body, key=self.key, digest_size=32)
        return int.from_bytes(h.digest(), "big")

    def _walk(self, name: str, n: int, x: int, back: bool) -> int:
        if not 0 <= x < n:
            raise ValueError(f"{x} is outside the domain of {name}")
        a = math.isqrt(n - 1) + 1
        b = -(-n // a)
        tweak = f"{name}:{n}:".encode()
        steps = range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)
        while True:
            left, right = divmod(x, b)
            for i in steps:
                sign = -1 if back else 1
                if i % 2:
                    right = (right + sign * self._round(tweak, i, left)) % b
                else:
                    left = (left + sign * self._round(tweak, i, right)) % a
            x = left * b + right
            if x < n:
                return x

    def permute(self, name: str, n: int, x: int) -> int:
        at = (name, n, x)
        if at not in self.known:
            if len(self.known) >= self.memory:
                self.known.clear()
            self.known[at] = self._walk(name, n, x, False)
        return self.known[at]

    def restore(self, name: str, n: int, y: int) -> int:
        return self._walk(name, n, y, True)


def luhn_digit(body: str) -> str:
    """The check digit that completes ``body``."""
    total = 0
    for i, c in enumerate(reversed(body)):
        d = int(c) * (1 if i % 2 else 2)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def iban_digits(country: str, account: str) -> str:
    """The two check digits of an IBAN."""
    number = "".join(str(int(c, 36)) for c in account + country + "00")
    return f"{98 - int(number) % 97:02d}"


# IBAN lengths by country.
IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29, "BY": 28,
    "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18,
    "FK": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HN": 28, "HR": 21, "HU": 28,
    "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28,
    "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24,
    "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "SO": 23, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26,
    "UA": 29, "VA": 22, "VG": 24, "XK": 20, "YE": 30}
# Country calling codes of one and two digits; all others have three.
SHORT_CODES = {"1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49",
               "51", "52", "53", "54", "55", "56", "57", "58", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86",
               "90", "91", "92", "93", "94", "95", "98"}

ALNUM = "0123456789abcdefghijklmnopqrstuvwxyz"
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1), dt.date(2099, 12, 31)
#: All days, by whether they are over the twelfth of their month.
DAYS = {late: [d for d in (FIRST_DAY + dt.timedelta(i) for i in range((LAST_DAY - FIRST_DAY).days + 1)) if (d.day > 12) == late]
        for late in (False, True)}

EMAIL = r"(?P<email>(?<![\w.+-])[^\W_](?:[\w.+-]{0,62}[^\W_])?@(?:[a-zA-Z0-9](?:[a-zA-Z0-9-]{0,61}[a-zA-Z0-9])?\.)+[a-zA-Z]{2,24}(?![\w-]))"
NUMBERS = "|".join((
    r"(?P<date>(?<![\w./-])(?:\d{4}-\d\d-\d\d|\d{4}/\d\d/\d\d|\d\d/\d\d/\d{4}|\d\d\.\d\d\.\d{4})(?![\w/-]|\.\d))",
    r"(?P<ipv4>(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d))",
    r"(?P<phone>(?<![\w+])\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}(?!\d)"
    r"|(?<![\w+])\+[2-9]\d{0,14}(?:[ .-]?\(\d{1,5}\))?(?:[ .-]?\d{2,14}){0,6}(?!\d)"
    r"|(?<![\w.+(-])(?:1[ .-])?(?:\([2-9]\d\d\) ?|[2-9]\d\d[.-])[2-9]\d\d[.-]\d{4}(?![\w-]|\.\d))",
    r"(?P<secret>(?<![0-9a-zA-Z])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![0-9a-zA-Z]))",
    r"(?P<iban>(?<![0-9a-zA-Z])[A-Z]{2}\d\d(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9a-zA-Z]))",
    r"(?P<card>(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-]|\.\d))",
))
FIND_EMAIL, FIND_NUMBER = re.compile(EMAIL), re.compile(NUMBERS)
#: Values written in groups: a match may hold a neighbouring group too.
GROUPS = {"card": re.compile(r"\d+"), "iban": re.compile(r"[A-Z0-9]+"), "phone": re.compile(r"\+?\(?\d+\)?")}
WHOLE = {"phone": re.compile(r"\+[2-9]\d{0,14}(?:[ .-]?\(\d{1,5}\))?(?:[ .-]?\d{2,14}){0,6}"), "card": re.compile(r"\d(?:[ -]?\d){12,18}"), "iban": re.compile(r"[A-Z]{2}\d\d(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?")}
HAS_DIGITS = re.compile(r"[0-9a-fA-F]{13}|\d[\d ./-]{5}\d")


def valid_card(value: str) -> bool:
    digits = re.sub(r"\D", "", value)
    return luhn_digit(digits[:-1]) == digits[-1] and bool(digits.strip("0"))


def valid_iban(value: str) -> bool:
    plain = value.replace(" ", "")
    return IBAN_LENGTH.get(plain[:2]) == len(plain) and iban_digits(plain[:2], plain[4:]) == plain[2:4]


def valid_phone(value: str) -> bool:
    return Pseudonymiser.PROBE.phone(value) is not None


VALID = {"card": valid_card, "iban": valid_iban, "phone": valid_phone}


def _relaid(layout: str, symbols: str) -> str:
    """``symbols`` in the places of the layout's letters and digits."""
    new = iter(symbols)
    return "".join(next(new) if c.isascii() and c.isalnum() else c for c in layout)


class Pseudonymiser:
    """Replaces validated values by their pseudonyms; ``back`` undoes it."""

    def __init__(self, key: bytes, back: bool = False):
        self.feistel, self.back = Feistel(key), back
        self._map = self.feistel.restore if back else self.feistel.permute

    def _digits(self, name: str, digits: str) -> str:
        return f"{self._map(name, 10 ** len(digits), int(digits)):0{len(digits)}d}"

    def card(self, value: str) -> str | None:
        digits = re.sub(r"\D", "", value)
        if not valid_card(value):
            return None
        body = self._digits("card", digits[:-1])
        return _relaid(value, body + luhn_digit(body))

    def _in_class(self, name: str, n: int, x: int, belongs) -> int:
        """The permutation walked on until it is back in ``x``'s class, so
        that each class is permuted within itself."""
        kind, y = belongs(x), self._map(name, n, x)
        while belongs(y) != kind:
            y = self._map(name, n, y)
        return y

    def _national(self, digits: str) -> str:
        """Ten digits of the +1 plan; where area and exchange begin with 2 to
        9, as the plan wants, the pseudonym's do too."""
        def planned(x: int) -> bool:
            return x // 10**9 > 1 and x // 10**6 % 10 > 1

        return f"{self._in_class('phone', 10**10, int(digits), planned):010d}"

    def phone(self, value: str) -> str | None:
        digits = re.sub(r"\D", "", value)
        if not value.startswith("+") or digits[0] == "1":
            return _relaid(value, digits[:-10] + self._national(digits[-10:]))
        code = next((digits[:n] for n in (1, 2) if digits[:n] in SHORT_CODES), digits[:3])
        rest = digits[len(code):]
        # an international number has at most 15 digits, its national part no 0 in front
        if not (8 <= len(digits) <= 15 and len(rest) >= 6 and rest[0] != "0"):
            return None
        new = self._in_class(f"phone-{code}", 10 ** len(rest), int(rest), lambda x: x >= 10 ** (len(rest) - 1))
        return _relaid(value, code + f"{new:0{len(rest)}d}")

    def ipv4(self, value: str) -> str | None:
        parts = [int(p) for p in value.split(".")]
        if max(parts) > 255:
            return None
        n = self._map("ipv4", 2**32, int.from_bytes(bytes(parts), "big"))
        return ".".join(map(str, n.to_bytes(4, "big")))

    def date(self, value: str) -> str | None:
        a, sep, b, _, c = re.split(r"(\D)", value)
        year, month, day = (a, b, c) if len(a) == 4 else (c, b, a)
        if len(a) != 4 and sep == "/" and int(month) > 12:  # month first
            month, day, month_first = day, month, True
        else:
            month_first = False
        try:
            at = dt.date(int(year), int(month), int(day))
        except ValueError:
            return None
        if not FIRST_DAY <= at <= LAST_DAY:
            return None
        # days over 12 and others are permuted among themselves, so that a
        # month-first date stays one, and the same for all layouts
        days = DAYS[at.day > 12]
        new = days[self._map(f"date-{at.day > 12}", len(days), bisect_left(days, at))]
        if month_first:
            return f"{new.month:02d}{sep}{new.day:02d}{sep}{new.year:04d}"
        if len(a) == 4:
            return f"{new.year:04d}{sep}{new.month:02d}{sep}{new.day:02d}"
        return f"{new.day:02d}{sep}{new.month:02d}{sep}{new.year:04d}"

    def iban(self, value: str) -> str | None:
        plain = value.replace(" ", "")
        country, account = plain[:2], plain[4:]
        if not valid_iban(value):
            return None
        # the kinds of the account's characters belong to the format
        at = [i for i, c in enumerate(account) if c.isdigit()]
        digits = self._digits(f"iban-{country}", "".join(account[i] for i in at)) if at else ""
        new = list(account)
        for i, c in zip(at, digits, strict=True):
            new[i] = c
        account = "".join(new)
        return _relaid(value, country + iban_digits(country, account) + account)

    def secret(self, value: str) -> str | None:
        n = self._map("secret", 16 ** len(value), int(value, 16))
        out = f"{n:0{len(value)}x}"
        return out.upper() if value.upper() == value else out

    def email(self, value: str) -> str | None:
        """The local part's letters and digits as one number, its
        punctuation and non-ASCII letters' places kept; the domain stays."""
        local, _, domain = value.rpartition("@")
        kinds = [(10, "0") if c.isdigit() else (26, "A") if c.isascii() and c.isupper() else (26, "a")
                 for c in local if c.isalnum()]
        base = {"0": "0", "A": "A", "a": "a"}
        n, x = 1, 0
        for (size, kind), c in zip(kinds, (c for c in local if c.isalnum()), strict=True):
            n *= size
            at = (ord(c) - ord(base[kind])) if c.isascii() else None
            if at is None or not 0 <= at < size:
                return self._odd_email(local, domain)
            x = x * size + at
        y = self._map("email:" + "".join(k for _, k in kinds), n, x)
        out = []
        for size, kind in reversed(kinds):
            y, at = divmod(y, size)
            out.append(chr(ord(base[kind]) + at))
        new = iter(reversed(out))
        return "".join(next(new) if c.isalnum() else c for c in local) + "@" + domain

    def _odd_email(self, local: str, domain: str) -> str:
        """Letters beyond ASCII: permuted within the 2048 code points that
        UTF-8 writes in two bytes, or 0x800 up to the surrogates, or beyond."""
        ranges = ((0, 0x80), (0x80, 0x800), (0x800, 0xD800), (0xE000, 0x110000))
        out = []
        for i, c in enumerate(local):
            low, high = next(r for r in ranges if r[0] <= ord(c) < r[1])
            if not c.isalnum():
                out.append(c)
                continue
            letters = _alnum_range(low, high)
            at = letters.index(c)
            out.append(letters[self._map(f"email-odd:{i}:{low}", len(letters), at)])
        return "".join(out) + "@" + domain

    def _part(self, kind: str, value: str, at: int) -> tuple[int, int] | None:
        """The leftmost, longest valid run of whole groups from ``at`` on."""
        groups = list(GROUPS[kind].finditer(value, at))
        for i, first in enumerate(groups):
            for last in reversed(groups[i:]):
                part = value[first.start():last.end()]
                if WHOLE[kind].fullmatch(part) and VALID[kind](part):
                    return first.start(), last.end()
        return None

    def _within(self, kind: str, value: str, found: Counter) -> str:
        """A match that is no valid value as a whole, with the valid runs of
        groups in it replaced. A pseudonym with which other groups would
        look valid is sent through again, so that ``back`` finds the same."""
        at = 0
        while span := self._part(kind, value, at):
            start, end = span
            while True:
                value = value[:start] + getattr(self, kind)(value[start:end]) + value[end:]
                if self._part(kind, value, at) == span:
                    break
            found[kind] += 1
            at = end
        return value

    def replace(self, text: str) -> tuple[str, Counter]:
        found: Counter = Counter()

        def one(m: re.Match) -> str:
            kind = m.lastgroup
            new = getattr(self, kind)(m[0])
            if new is None:
                return self._within(kind, m[0], found) if kind in GROUPS else m[0]
            found[kind] += 1
            return new

        if HAS_DIGITS.search(text):
            text = FIND_NUMBER.sub(one, text)
        if "@" in text:
            text = FIND_EMAIL.sub(one, text)
        return text, found


Pseudonymiser.PROBE = Pseudonymiser(b"")

_ALNUM_RANGES: dict[tuple[int, int], str] = {}


def _alnum_range(low: int, high: int) -> str:
    if (low, high) not in _ALNUM_RANGES:
        _ALNUM_RANGES[low, high] = "".join(c for c in map(chr, range(low, high)) if c.isalnum())
    return _ALNUM_RANGES[low, high]


def pseudonymise(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text", back: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, ``text`` with every validated value
    replaced, ``n_replaced`` and a count per kind (``n_card``, ``n_phone``,
    ``n_ipv4``, ``n_date``, ``n_iban``, ``n_email``, ``n_secret``).

    Numbers must be valid to be touched: Luhn for cards, modulus 97 for
    IBANs, octets for addresses, the calendar (1900 to 2099) for dates; phones
    are +1 numbers, national ones of that plan with separators, and other
    international ones of 8 to 15 digits behind a ``+``. Other digits stay as they are. With
    ``back`` the same call restores pseudonyms. Null stays null with zero
    counts; everything outside the values is unchanged. Rows, repeated or
    not, are independent; no shuffle."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        change = Pseudonymiser(key, back)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                texts, counts = [], []
                for text in part.column(1):
                    text = text.as_py()
                    new, found = (None, Counter()) if text is None else change.replace(text)
                    texts.append(new)
                    counts.append(found)
                columns = [part.column(0), pa.array(texts, pa.string()), pa.array([c.total() for c in counts], pa.int64())]
                columns += [pa.array([c[k] for c in counts], pa.int64()) for k in KINDS]
                yield pa.RecordBatch.from_arrays(columns, ["id", "text", "n_replaced", *(f"n_{k}" for k in KINDS)])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(run, f"id {id_type}, text string, n_replaced long, " + ", ".join(f"n_{k} long" for k in KINDS))
    return out.withColumnRenamed("id", id_col)
