"""Mixing sources to target weights, in DataFrame functions only.

Every document gets a hash-random key. Within a source, documents are
ordered by that key and their token counts summed to distributed prefix
sums; the source's budget is whole epochs plus a remainder, and the
remainder is cut in that order. Nothing is sampled and nothing depends on
partitioning, so reruns agree.

At scale: the key's leading bits deal each source's rows into as many
ranges of about ``rows_per_range`` rows as it needs, so a source with a
third of all rows spreads over many tasks. A prefix sum has three parts: the
range's offset, the offset of a key within its range, and a running sum over
the rows of one key. Rows share a key only if they repeat both id and text;
however many do (a third of all rows, say), they are summed by the slice of
the table that holds them first, so no task gets more of them than a slice
has."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from lectio.llm.common import n_words, written

#: Hex digits of the key that number its range.
RANGE_DIGITS = 8


def source_targets(totals: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share_pct: int = 150,
                   max_epochs: int = 2) -> DataFrame:
    """(source, source_size) -> the same rows with ``target``.

    Sources in code-point order, null last, weigh ``weights`` repeating and
    share ``share_pct`` per cent of all sizes by weight; a target stops at
    ``max_epochs`` times its source's size and the excess is shared again
    until none is above. That end state has a closed form: in order of
    cap/weight the first sources are at their cap and the others share what
    is left by weight. One row per source goes through the windows, never
    documents. Without any words all targets are 0."""
    first = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    w = F.element_at(F.array(*(F.lit(x).cast("long") for x in weights)),
                     ((F.row_number().over(first) - 1) % len(weights) + 1).cast("int"))
    ranked = totals.withColumn("w", w).withColumn("cap", F.col("source_size") * max_epochs)
    by_ratio = (Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col("source").isNull(), F.col("source").cast("binary"))
                .rowsBetween(Window.unboundedPreceding, -1))
    whole = Window.partitionBy()
    ranked = (ranked
              .withColumn("cap_before", F.coalesce(F.sum("cap").over(by_ratio), F.lit(0).cast("long")))
              .withColumn("w_before", F.coalesce(F.sum("w").over(by_ratio), F.lit(0).cast("long")))
              .withColumn("size_all", F.sum("source_size").over(whole))
              .withColumn("w_all", F.sum("w").over(whole)))
    # in hundredths, so that every operand is a whole number until one division
    left = F.lit(share_pct) * F.col("size_all") - 100 * F.col("cap_before")
    weight_left = F.col("w_all") - F.col("w_before")
    open_ = left / weight_left <= 100 * F.col("cap") / F.col("w")
    ranked = ranked.withColumn("left", left).withColumn("weight_left", weight_left).withColumn("open", open_)
    # the first source that is not at its cap fixes the level of all later ones
    level = (F.min(F.when(F.col("open"), F.struct((F.col("cap") / F.col("w")).alias("r"), F.col("w_before"), F.col("left"),
                                                  F.col("weight_left")))).over(whole))
    ranked = ranked.withColumn("level", level)
    capped = F.col("level").isNull() | (F.col("w_before") < F.col("level.w_before"))
    target = F.when(capped, F.col("cap").cast("double")).otherwise(
        (F.col("level.left") * F.col("w")).cast("double") / (100 * F.col("level.weight_left")).cast("double"))
    return ranked.select("source", "source_size", target.alias("target"))


def _rows(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str, *others: Column) -> DataFrame:
    """(row, slice, id, source, size, key, others...), numbered and written:
    whatever is planned for a row reaches that row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), F.md5(text)))
    return written(docs.select(F.monotonically_increasing_id().alias("row"), F.spark_partition_id().alias("slice"),
                               F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                               n_words(F.col(text_col)).alias("size"), key.alias("key"), *others), "mix-sizes")


def _before(*by: str) -> WindowSpec:
    return Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)


def _so_far(of: str, window: WindowSpec) -> Column:
    return F.coalesce(F.sum(of).over(window), F.lit(0).cast("long"))


def _planned(rows: DataFrame, weights: tuple[int, ...], share_pct: int, max_epochs: int, rows_per_range: int) -> DataFrame:
    """The ``rows`` of :func:`_rows` with source_size, target and epochs."""
    counts = written(rows.groupBy(F.col("source").alias("c_source")).agg(
        F.ceil(F.count(F.lit(1)) / rows_per_range).alias("ranges")), "mix-counts")
    rows = (rows.join(counts, F.col("source").eqNullSafe(F.col("c_source")))
            .withColumn("range", F.floor(F.conv(F.substring("key", 1, RANGE_DIGITS), 16, 10).cast("long")
                                         * F.col("ranges") / 16**RANGE_DIGITS).cast("long"))
            .select("row", "slice", "id", "source", "size", "key", "range"))
    keys = written(rows.groupBy("source", "range", "key", "slice").agg(F.sum("size").alias("key_size")), "mix-keys")
    parts = written(keys.groupBy("source", "range").agg(F.sum("key_size").alias("part_size")), "mix-parts")
    targets = source_targets(parts.groupBy("source").agg(F.sum("part_size").alias("source_size")), weights, share_pct,
                             max_epochs)
    offsets = (parts.withColumn("offset", _so_far("part_size", _before("source").orderBy("range")))
               .select(F.col("source").alias("o_source"), F.col("range").alias("o_range"), "offset"))
    plan = written(offsets.join(targets, F.col("o_source").eqNullSafe(F.col("source"))).drop("source"), "mix-plan")
    begins = keys.select("source", "range", "key", "slice",
                         _so_far("key_size", _before("source", "range").orderBy("key", "slice")).alias("key_offset"))
    placed = (begins.join(plan, F.col("source").eqNullSafe(F.col("o_source")) & (F.col("range") == F.col("o_range")))
              .select(F.col("source").alias("k_source"), F.col("key").alias("k_key"), F.col("slice").alias("k_slice"),
                      (F.col("offset") + F.col("key_offset")).alias("begin"), "source_size", "target"))
    summed = rows.withColumn("inside", _so_far("size", _before("source", "key", "slice").orderBy("row")))
    same = F.col("source").eqNullSafe(F.col("k_source")) & (F.col("key") == F.col("k_key")) & (F.col("slice") == F.col("k_slice"))
    budget = F.round("target").cast("long")
    return (summed.join(placed, same)
            .withColumn("full", F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)))
            .withColumn("rest", budget - F.col("full") * F.col("source_size"))
            .withColumn("epochs", (F.col("full") + F.when(
                2 * (F.col("begin") + F.col("inside")) + F.col("size") <= 2 * F.col("rest"), F.lit(1)).otherwise(F.lit(0))
            ).cast("long"))
            .withColumn("epochs", F.least("epochs", F.lit(max_epochs).cast("long")))
            .select("row", "id", "size", "source", "source_size", "target", "epochs"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[int, ...] = (3, 1, 2), share_pct: int = 150, max_epochs: int = 2,
                seed: str = "mix-1", rows_per_range: int = 4_000) -> DataFrame:
    """One row per row of ``docs``: id, ``size`` (words; null text: 0),
    source, ``source_size``, ``target``, ``epochs`` (times the mix takes the
    document) and ``taken`` (its words, repeats counted).

    The budget of a source is its target rounded to words. Full epochs take
    every document; the remainder takes documents in key order while their
    midpoint lies within it, so a source misses its target by half of one
    document at most and no document is cut. The key is a hash of id and
    text: null and repeated ids spread like others, and only rows that repeat
    both follow each other. Null sources form a source of their own.
    Documents without words take no budget: they follow the cut like the
    others, with ``taken`` 0. An empty table gives no rows."""
    plan = _planned(_rows(docs, id_col, text_col, source_col, seed), weights, share_pct, max_epochs, rows_per_range)
    return plan.select(F.col("id").alias(id_col), "size", F.col("source").alias(source_col), "source_size", "target", "epochs",
                       (F.col("epochs") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    weights: tuple[int, ...] = (3, 1, 2), share_pct: int = 150, max_epochs: int = 2,
                    seed: str = "mix-1", rows_per_range: int = 4_000) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as the mix takes it.
    The rows are numbered before they are planned and found again by their
    number, so the words delivered are the words planned, null and repeated
    ids included."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    rows = _rows(docs, id_col, text_col, source_col, seed, F.struct(*(F.col(f"`{c}`").alias(n) for c, n in names.items())).alias("doc"))
    plan = (_planned(rows.drop("doc"), weights, share_pct, max_epochs, rows_per_range).where("epochs > 0")
            .select(F.col("row").alias("taken"), "epochs"))
    chosen = rows.select("row", "doc").join(plan, F.col("row") == F.col("taken"))
    return (chosen.select("doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("epochs"))))
            .select(*(F.col(f"doc.{n}").alias(c) for c, n in names.items())))
