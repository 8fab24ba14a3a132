"""Connected components of an edge table, without a driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectio.llm.common import written


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(u, v) longs -> (node, component): the smallest node of the
    component, for every node that has an edge to a smaller one; the
    smallest nodes themselves are left out.

    Alternates two contractions until nothing changes: every node hands its
    larger neighbours to its smallest neighbour, then its smaller ones. Both
    are a grouped minimum and an equi-join, so a node with very many edges
    is pre-aggregated and can be split. Null ends and loops are ignored."""
    clean = edges.where("u is not null and v is not null and u <> v")
    # larger end first
    state = written(clean.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while (now := _digest(state)) != before:
        before = now
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("least")).select(F.col("u").alias("w"), F.least("least", "u").alias("m"))
        large = (both.where("v > u").join(low, F.col("u") == F.col("w"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        joined = large.join(low, F.col("u") == F.col("w"))
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(joined.select("u", F.col("m").alias("v")))
        state = written(small.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                        "edges")
    return state.select(F.col("u").alias("node"), F.col("v").alias("component"))
