"""URL filter rules as one bit-parallel wildcard automaton.

All glob rules are packed side by side into the bits of one multiword
integer: a rule of m characters takes m + 1 bits, bit j meaning "the first j
characters have matched". Reading one character of the canonical URL moves
all rules at once (Shift-And): ``D' = ((D << 1) & B[c]) | (D & S[c])``,
where ``B[c]`` holds the positions that c enters and ``S[c]`` the positions
that stay on c because a wildcard follows them.

Globs: ``*`` is any run without ``/``, ``**`` any run, ``?`` any single
character except ``/``; everything else is literal."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class UrlRule:
    """``verdict`` is allow or block. ``label`` names the rule in results.
    Of the rules that match, the longest ``label`` wins; a rule without a
    label only decides where no labelled rule matches."""

    glob: str
    verdict: str
    label: str | None = None


def host_rule(host: str, path: str, verdict: str) -> UrlRule:
    """Fits the host and all its subdomains, for paths that start with
    ``path``. Canonical URLs begin with a dot before the host."""
    return UrlRule(f"*.{host}{path}**", verdict, host + path)


class WildcardAutomaton:
    """The compiled masks of a list of globs."""

    def __init__(self, globs: Sequence[str]):
        self.start = 0
        self.finals: list[int] = []
        enters: dict[str, int] = {}
        stay_any = stay_in_part = enter_any = 0  # masks of **, * and ?
        at = 0
        for glob in globs:
            self.start |= 1 << at
            i = 0
            while i < len(glob):
                if glob.startswith("**", i):
                    stay_any |= 1 << at
                    i += 2
                    continue
                if glob[i] == "*":
                    stay_in_part |= 1 << at
                else:
                    at += 1
                    if glob[i] == "?":
                        enter_any |= 1 << at
                    else:
                        enters[glob[i]] = enters.get(glob[i], 0) | 1 << at
                i += 1
            self.finals.append(1 << at)
            at += 1
        self.n_bits = at
        self.other = (enter_any, stay_any | stay_in_part)  # a character no rule names
        self.table = {c: (m | (enter_any if c != "/" else 0), stay_any | (stay_in_part if c != "/" else 0))
                      for c, m in {"/": 0, **enters}.items()}

    def run(self, subject: str) -> int:
        """The bits of the rules that match the whole subject."""
        state, table, other = self.start, self.table, self.other
        for c in subject:
            enter, stay = table.get(c, other)
            state = ((state << 1) & enter) | (state & stay)
            if not state:
                break
        return state

    def matches(self, subject: str) -> list[int]:
        state = self.run(subject)
        return [i for i, final in enumerate(self.finals) if state & final]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty for null or without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty likewise."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def judge_urls(pages: DataFrame, rules: Sequence[UrlRule], id_col: str = "page_id", url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """One row per row of ``pages``: id, ``host``, ``path``, ``rule`` (label
    of the longest labelled rule that fits, else null), ``verdict`` (that
    rule's; else block if any unlabelled rule that blocks fits, else allow
    if one that allows fits, else ``default``) and ``n_matches``.

    The canonical URL is ``.host`` + path; null or relative URLs have an
    empty one. Of labels of equal length the first rule listed wins. Repeated
    rows and null ids are judged like any other; no shuffle."""
    rules = list(rules)
    automaton = WildcardAutomaton([r.glob for r in rules])

    @F.pandas_udf("rule string, verdict string, n_matches int")
    def judge(subjects: pd.Series) -> pd.DataFrame:
        out = []
        for subject in subjects:
            hit = [rules[i] for i in automaton.matches(subject)]
            named = [r for r in hit if r.label is not None]
            if named:
                best = max(named, key=lambda r: len(r.label))
                out.append((best.label, best.verdict, len(hit)))
            else:
                verdicts = {r.verdict for r in hit}
                out.append((None, "block" if "block" in verdicts else "allow" if verdicts else default, len(hit)))
        return pd.DataFrame(out, columns=["rule", "verdict", "n_matches"])

    split = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    judged = split.withColumn("j", judge(F.concat(F.lit("."), "host", "path")))
    return judged.select(F.col("id").alias(id_col), "host", "path", "j.rule", "j.verdict", "j.n_matches")
