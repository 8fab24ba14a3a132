"""Multi-label keyword classification with rules as data (K1-K3).

A rule is (label, contains, equals, startswith). A value matches when its
normalised form (lower, stripped) contains any ``contains`` keyword, equals
any ``equals`` keyword or starts with any ``startswith`` keyword. The
labels of a row are deduplicated and sorted by code point; NULL or empty
input gives ``[]`` (never NULL, so ``size`` splits rows cleanly).

Evaluated as codegen'd string tests on one joined column per row (no
Python worker, no interpreted lambdas). The joined column is shared within a
projection but not within a filter, so don't filter on the labels directly:
Catalyst would push the filter below the projection and evaluate the
normalisation once per test. Filter on a generator's output instead (see
``genre.by_first_genre`` and :func:`unmatched`).
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



class Rule(NamedTuple):
    label: str
    contains: tuple[str, ...] = ()
    equals: tuple[str, ...] = ()
    startswith: tuple[str, ...] = ()


# The genre rules (label, substrings, whole values, prefixes).
GENRE_RULES = [
    Rule("Science Fiction", ("science fiction", "sci-fi", "science-fiction")),
    Rule("Fantasy", ("fantasy",)),
    Rule("Historical Fiction", ("historical fiction", "fiction, historical"), ("historical",)),
    Rule("Mystery & Crime", ("mystery", "detective", "misterio"),
         ("suspense fiction", "fiction, suspense", "roman policier")),
    Rule("Thriller", ("thriller",), ("suspense & thriller", "thrillers & suspense",
                                    "novela de suspense")),
    Rule("Romance", ("romance",), ("love stories", "love & romance")),
    Rule("Dystopian", ("dystop",), ("post-apocalyptic fiction", "apocalyptic fiction")),
    Rule("Young Adult", ("young adult",), ("ya", "teen fiction", "teenage literature")),
    Rule("Literary Fiction", ("literary", "classic")),
    Rule("Graphic Novel", ("graphic novel", "comic")),
    Rule("LGBTQ+", ("lgbt", " gay "), (), ("gay",)),
    Rule("Action & Adventure", ("adventure",), ("action & adventure", "action/adventure",
                                                "action and adventure fiction")),
]


# Boundary marker between values in the joined form (a
# control character no keyword contains).
SEP = "\u001f"


def joined_values(values: Column) -> Column:
    """All values lowercased and joined as ``SEP v1 SEP v2 ... SEP`` with
    white space around every value stripped. Each rule then becomes plain
    string tests on one column, all whole-stage-codegen'd:
    contains k -> ``contains(j, k)``; equals k -> ``contains(j, SEP k SEP)``;
    starts with k -> ``contains(j, SEP k)``. (A value holding the control
    character SEP itself would be split there.)"""
    arr = F.coalesce(values, F.array().cast("array<string>"))
    j = F.concat(F.lit(SEP), F.lower(F.array_join(arr, SEP)), F.lit(SEP))
    return F.regexp_replace(j, "(?U)\\s*" + SEP + "\\s*", SEP)


def rule_matches(j: Column, rule: Rule) -> Column:
    """Does any value of the joined form ``j`` match ``rule``?"""
    tests = ([F.contains(j, F.lit(k)) for k in rule.contains]
             + [F.contains(j, F.lit(SEP + k + SEP)) for k in rule.equals]
             + [F.contains(j, F.lit(SEP + k)) for k in rule.startswith])
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def classify(values: Column | str, rules: list[Rule] = GENRE_RULES) -> Column:
    """array<string> of matched labels, sorted and distinct ([] for none)."""
    values = F.col(values) if isinstance(values, str) else values
    j = joined_values(values)
    hits = F.concat_ws(SEP, *[F.when(rule_matches(j, r), F.lit(r.label)) for r in rules])
    labels = F.when(hits == "", F.array().cast("array<string>")).otherwise(F.split(hits, SEP))
    return F.sort_array(F.array_distinct(labels))


def with_labels(df: DataFrame, values: str = "subjects", rules: list[Rule] = GENRE_RULES,
                out: str = "genres") -> DataFrame:
    """K1 as a column, computed once; split with :func:`unmatched` afterwards."""
    return df.withColumn(out, classify(values, rules))


def unmatched(df: DataFrame, cols: list[str], out: str = "genres") -> DataFrame:
    """K3: rows no rule matched."""
    first = df.select(*cols, F.explode_outer(F.slice(out, 1, 1)).alias("_label"))
    return first.where(F.col("_label").isNull()).select(*cols)


def rules_from_records(records) -> list[Rule]:
    """Rules from flat records ``{"label", "kind", "keyword"}`` with kind
    one of contains / equals / startswith (e.g. a small JSON file kept
    next to the job). Labels keep their first-seen order; keywords are
    matched against lower-cased, stripped values, so they are lower-cased."""
    kinds = ("contains", "equals", "startswith")
    grouped: dict[str, dict[str, list[str]]] = {}
    for r in records:
        if r["kind"] not in kinds:
            raise ValueError(f"unknown rule kind {r['kind']!r}")
        grouped.setdefault(r["label"], {k: [] for k in kinds})[r["kind"]].append(r["keyword"].lower())
    return [Rule(label, *(tuple(g[k]) for k in kinds)) for label, g in grouped.items()]


def labels_of(rules: list[Rule]) -> list[str]:
    return sorted({r.label for r in rules})
