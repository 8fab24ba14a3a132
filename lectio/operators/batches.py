"""Append-only history -> newest snapshot (F1), and batch stamping."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectio.session import scratch_path


def latest_batch(df: DataFrame, ts: str = "_ingested_at") -> DataFrame:
    """Rows whose ``ts`` equals the table maximum.

    An uncorrelated scalar subquery, not a driver round trip: Catalyst
    runs the max as a subquery and, when ``ts`` is a partition column of
    the bronze directory, prunes every older batch's files. Empty input
    -> max NULL -> no rows."""
    newest = df.select(F.max(ts)).scalar()
    return df.filter(F.col(ts) == newest)


def latest_written(df: DataFrame, ts: str = "_ingested_at") -> DataFrame:
    """F1 for a frame that is derived on the fly: it is derived once and
    written, and newest value and rows are read from what was written. (On a
    plain scan :func:`latest_batch` reads the source's own ``ts`` column and
    needs no copy.)"""
    spark = df.sparkSession
    path = scratch_path(spark, "snapshot")
    df.write.parquet(path)
    return latest_batch(spark.read.schema(df.schema).parquet(path), ts)


def stamp_batch(df: DataFrame, source: str, batch_ts: _dt.datetime | str | None = None) -> DataFrame:
    """``_ingested_at`` (one constant per batch) and ``_source``. Pass
    ``batch_ts`` to make retries and tests deterministic; otherwise the
    query-start ``current_timestamp()`` (constant within one query)."""
    stamp = (F.lit(batch_ts).cast("timestamp") if batch_ts is not None
             else F.current_timestamp())
    return df.withColumn("_ingested_at", stamp).withColumn("_source", F.lit(source))
