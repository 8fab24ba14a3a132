"""Exact deduplication by distributed most-significant-digit radix
partitioning.

A document's digits are successive byte blocks of its normalised text: 64
bytes, then blocks that grow by a factor, so a text of n bytes has
O(log n) digits. Each round splits every group of documents by its next
digit. A document alone in its group is unique and leaves; a group whose
texts have ended is a group of equal texts and leaves; only the others go
on. Texts are equal because all their bytes were compared; no digest
decides anything.

At scale: groups are counted with map-side aggregation, so a group of
copies that holds a third of all rows costs one row per map task there, and
documents learn their group by a sort-merge join with the written counts,
whose large side Spark can split. Whole rows cross the network once, in the
first digit's join; after that only rows that still have company move, once
a round, and a digit is replaced by its group's number as soon as it has
been compared."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectio.llm.common import written

FIRST_BLOCK, GROWTH, MAX_BYTES = 64, 64, 2**31 - 1


def lower_ascii(text: Column) -> Column:
    """The text with A-Z lower-cased and nothing else changed, which keeps
    every byte's place; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def normalise(text: Column) -> Column:
    """UTF-8 bytes of :func:`lower_ascii`."""
    return lower_ascii(text).cast("binary")


def blocks(first: int = FIRST_BLOCK, growth: int = GROWTH) -> list[tuple[int, int]]:
    """(offset, width) of each digit, up to the largest text Spark holds."""
    out, at, width = [], 0, first
    while at < MAX_BYTES:
        width = min(width, MAX_BYTES - at)
        out.append((at, width))
        at, width = at + width, width * growth
    return out


def _digit(text: Column, at: int, width: int) -> Column:
    """The digit at byte ``at``. The first ``width`` bytes lie within the
    first ``width`` characters, so the first digit reads no more of the text."""
    return F.substring(normalise(F.left(text, F.lit(width)) if at == 0 else text), at + 1, width)


def _split(rows: DataFrame, text: Column, k: int, at: int, width: int, name: str) -> DataFrame:
    """``rows`` (id, row, group, ...) split by digit ``k`` of their ``text``.
    Adds of the new group, all null for a row that is alone in it: its
    ``number``, its size ``n``, the ``keep`` (id, row) that stays; ``ends``
    tells whether the text has ended.

    Only the digits of groups with company are written and joined, always by
    a merge join: what moves is in proportion to the input at every size."""
    rows = (rows.withColumn("digit", _digit(text, at, width))
            .withColumn("ends", F.coalesce(F.octet_length(text), F.lit(0)) <= at + width))
    shared = written(rows.groupBy("group", "digit", "ends").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.struct("id", "row")).alias("keep")).where("n > 1")
        .select(F.col("group").alias("c_group"), F.col("digit").alias("c_digit"), F.col("ends").alias("c_ends"), "n", "keep",
                F.monotonically_increasing_id().alias("number")), f"radix-shared-{name}-{k}")
    same = ((F.col("group") == F.col("c_group")) & (F.col("digit") == F.col("c_digit")) & (F.col("ends") == F.col("c_ends")))
    return rows.join(shared.hint("merge"), same, "left")


def _rounds(docs: DataFrame, doc: Column, text: Column, id_col: str, first: int, growth: int, name: str,
            settle: Callable[[Column], Column]) -> list[DataFrame]:
    """The rows of ``docs`` as they leave, one written frame per round:
    (id, keep_id, n, kept, doc). ``doc`` is what travels with a row, ``text``
    the text in it; ``settle(alone)`` is ``doc`` as it is written after the
    first digit."""
    digit = blocks(first, growth)
    # rows are numbered when they are first written, after the first digit
    base = docs.select(F.col(id_col).alias("id"), F.lit(None).cast("long").alias("row"), F.lit(0).cast("long").alias("group"),
                       doc.alias("doc"))
    rows = written(_split(base, text, 0, *digit[0], name).select(
        F.monotonically_increasing_id().alias("row"), "id", F.col("number").alias("group"),
        settle(F.col("number").isNull()).alias("doc")), f"radix-rows-{name}")
    done = [rows.where("group is null").select("id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("n"),
                                               F.lit(True).alias("kept"), "doc")]
    rows = rows.where("group is not null")
    # a text that ended in the first digit has an empty second one
    for k in range(1, len(digit)):
        alone = F.col("number").isNull()
        state = written(_split(rows, text, k, *digit[k], name).select(
            "row", "id", F.col("number").alias("group"), "doc", F.coalesce("n", F.lit(1).cast("long")).alias("n"),
            (alone | F.col("ends")).alias("leaves"), F.when(alone, F.col("id")).otherwise(F.col("keep.id")).alias("keep_id"),
            (alone | (F.col("keep.row") == F.col("row"))).alias("kept")), f"radix-round-{name}-{k}")
        done.append(state.where("leaves").select("id", "keep_id", "n", "kept", "doc"))
        rows = state.where("not leaves").select("row", "id", "group", "doc")
        if rows.isEmpty():
            break
    return done


def _union(parts: list[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def equal_text_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      first: int = FIRST_BLOCK, growth: int = GROWTH) -> DataFrame:
    """One row per row of ``docs``: id, ``keep_id`` (largest id of the
    group), ``group_size``, ``kept`` and ``text_sha256`` of the normalised
    text (an output only; nothing is decided by it).

    Null texts equal empty texts. A null id sorts below all others, so it
    stays only in a group without any other id. Where rows repeat an id and
    a text, exactly one of them is kept. An empty table gives no rows."""
    text = F.col("doc.text")
    parts = _rounds(docs, F.struct(F.col(text_col).alias("text")), text, id_col, first, growth, "groups",
                    lambda alone: F.struct(F.sha2(normalise(text), 256).alias("sha"), F.when(~alone, text).alias("text")))
    return _union(parts).select(F.col("id").alias(id_col), "keep_id", F.col("n").alias("group_size"), "kept",
                                F.col("doc.sha").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", first: int = FIRST_BLOCK,
                growth: int = GROWTH) -> DataFrame:
    """The rows of ``docs``, all columns, that stay: one of each group of
    equal texts, rows that repeat both id and text included. The rows travel
    with their text through the rounds, so nothing is looked up again."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    parts = _rounds(docs, F.struct(*(F.col(f"`{c}`").alias(n) for c, n in names.items())), F.col(f"doc.{names[text_col]}"),
                    id_col, first, growth, "docs", lambda alone: F.col("doc"))
    return _union([p.where("kept").select(*(F.col(f"doc.{n}").alias(c) for c, n in names.items())) for p in parts])
