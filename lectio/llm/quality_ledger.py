"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document. The ledger stores the
measurements and one bit per failed rule; a policy is a named, versioned set
of rules, i.e. a bit mask, and its verdict is ``failed_bits & mask == 0``.
New policy versions and ablations need no second look at the texts: they
are bit operations over the ledger, aggregated by distinct bit pattern."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 5
SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\x0b\x0c\r"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_exclaims",
            "n_stutters")
MEASURE_TYPE = T.StructType([T.StructField(m, T.LongType()) for m in MEASURES])


@dataclass(frozen=True)
class Rule:
    """``fails`` takes a function from measurement name to its column."""

    name: str
    fails: Callable[[Callable[[str], Column]], Column]


# The position of a rule is its bit: append new rules, never reorder.
RULES = (
    Rule("too_few_words", lambda m: m("n_words") < 10),
    Rule("repeated_windows", lambda m: 100 * m("n_repeat_words") > 20 * m("n_words")),
    Rule("symbols", lambda m: 10 * m("n_symbols") > m("n_words")),
    Rule("shouting", lambda m: 2 * m("n_exclaims") > m("n_words")),
    Rule("repeated_lines", lambda m: 10 * m("n_dup_lines") > 6 * m("n_lines")),
    Rule("stutter", lambda m: 10 * m("n_stutters") > 4 * m("n_words")),
)

#: Versioned policies: the rules that reject.
POLICIES = {
    "base-1": ("too_few_words", "repeated_windows"),
    "corpus-1": ("too_few_words", "repeated_windows", "symbols", "shouting"),
    "corpus-2": tuple(r.name for r in RULES),
}
CURRENT = "corpus-2"


def policy_mask(policy: str) -> int:
    bit = {r.name: 1 << i for i, r in enumerate(RULES)}
    return sum(bit[name] for name in POLICIES[policy])


def repeated_window_words(words: list[bytes]) -> int:
    """Words covered by ``WINDOW``-word windows that occur at least twice."""
    n = len(words)
    if n <= WINDOW:
        return 0
    windows = list(zip(*(words[k:] for k in range(WINDOW)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    seen = Counter(windows)
    hit = np.fromiter((seen[w] > 1 for w in windows), bool, len(windows))
    covered = np.zeros(n, bool)
    for k in range(WINDOW):
        covered[k:k + len(hit)] |= hit
    return int(covered.sum())


def measure_text(text: str | None) -> tuple[int, ...]:
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at exactly the six ASCII white-space characters
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return (
        len(words),
        len(text) - (len(raw) - len(raw.translate(None, SPACE))),
        len(raw) - len(raw.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_window_words(words),
        len(lines),
        raw.count(b"!"),
        sum(map(bytes.__eq__, words, words[1:])),
    )


@F.pandas_udf(MEASURE_TYPE)
def _measure(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measure_text(t) for t in texts], columns=list(MEASURES), dtype="int64")


def failed_bits(measure: Callable[[str], Column]) -> Column:
    """All rules' failure bits as one long."""
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(rule.fails(measure), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return bits


def quality_ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, the measurements and
    ``failed_bits``.

    A null text counts as empty: no words, so it fails ``too_few_words``.
    Repeated rows and null ids keep a ledger row each. No shuffle: the
    measurements are one Arrow-batched pass and the rules are JVM
    expressions over them."""
    measured = docs.select(F.col(id_col).alias("id"), _measure(F.col(text_col)).alias("m"))
    return measured.select(
        F.col("id").alias(id_col), *(F.col(f"m.{m}").alias(m) for m in MEASURES),
        failed_bits(lambda m: F.col(f"m.{m}")).alias("failed_bits"))


def passes(policy: str = CURRENT, bits: str = "failed_bits") -> Column:
    """The policy's verdict on a ledger row."""
    return F.col(bits).bitwiseAND(F.lit(policy_mask(policy)).cast("long")) == 0


def keep_documents(docs: DataFrame, policy: str = CURRENT, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that the policy keeps."""
    m = _measure(F.col(text_col))
    bits = failed_bits(lambda name: m[name])
    return docs.where(bits.bitwiseAND(F.lit(policy_mask(policy)).cast("long")) == 0)


def ablations(ledger: DataFrame, policies: tuple[str, ...] = tuple(POLICIES)) -> DataFrame:
    """Per policy and rule: documents failing the rule, documents the policy
    rejects, and documents only this rule rejects, i.e. what leaving it out
    would bring back. Aggregates to the distinct bit patterns first, so the
    rest is independent of the number of documents. An empty ledger gives
    no rows."""
    patterns = ledger.groupBy("failed_bits").agg(F.count(F.lit(1)).alias("n"))
    rules = F.explode(F.array(*(
        F.struct(F.lit(p).alias("policy"), F.lit(policy_mask(p)).cast("long").alias("mask"),
                 F.lit(r.name).alias("rule"), F.lit(1 << i).cast("long").alias("bit"))
        for p in policies for i, r in enumerate(RULES) if r.name in POLICIES[p]))).alias("r")
    masked = F.col("failed_bits").bitwiseAND(F.col("r.mask"))

    def total(cond: Column) -> Column:
        return F.sum(F.when(cond, F.col("n")).otherwise(F.lit(0)))

    return patterns.select("failed_bits", "n", rules).groupBy("r.policy", "r.rule").agg(
        total(masked.bitwiseAND(F.col("r.bit")) != 0).alias("n_fail"),
        total(masked != 0).alias("n_rejected"),
        total(masked == F.col("r.bit")).alias("n_only_this"))
