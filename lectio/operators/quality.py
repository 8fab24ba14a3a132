"""Filters, reject reports and run metrics."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def non_empty(c: str) -> Column:
    """not NULL and not ''."""
    return F.col(c).isNotNull() & (F.col(c) != "")


def positive(c: str) -> Column:
    """not NULL and > 0."""
    return F.col(c).isNotNull() & (F.col(c) > 0)


def validate_pages(df: DataFrame, html: str = "raw_html", key: str = "book_id",
                   mode: str = "fail") -> DataFrame | tuple[DataFrame, DataFrame]:
    """Every page must contain its key.

    ``fail``: the query raises at the first bad page (the reference aborts
    the run). ``quarantine``: returns (good, rejected) with no error.
    ``flag``: adds a boolean ``page_valid`` column."""
    ok = F.coalesce(F.contains(F.col(html), F.col(key)), F.lit(False))
    if mode == "fail":
        k = F.coalesce(F.col(key), F.lit("NULL"))
        why = F.when(F.col(html).isNull(), F.concat(F.lit("no page landed for key '"), k, F.lit("'"))) \
            .otherwise(F.concat(F.lit("page for key '"), k,
                                F.lit("' does not contain the key: session may have expired")))
        return df.filter(F.when(ok, F.lit(True)).otherwise(F.raise_error(why)))
    if mode == "quarantine":
        return df.filter(ok), df.filter(~ok)
    if mode == "flag":
        return df.withColumn("page_valid", ok)
    raise ValueError(f"unknown mode {mode!r}")


def with_row_count(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Row count collected by the job that consumes ``df`` (e.g. the
    write), instead of a separate ``count()`` job re-running the lineage."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


METRICS_SCHEMA = "run string, stage string, `table` string, rows long, written_at timestamp"


def record_metrics(spark: SparkSession, path: str, run: str, stage: str, rows: dict[str, int]) -> None:
    """The row counts of a stage's tables, as rows of a table keyed by
    run, stage and table. A stage that is run again under the same run adds
    its counts anew; :func:`read_metrics` takes the last ones."""
    now = _dt.datetime.now(_dt.timezone.utc)
    spark.createDataFrame([(run, stage, t, n, now) for t, n in sorted(rows.items())], METRICS_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """(run, stage, table, rows): the last counts of each."""
    rows = spark.read.schema(METRICS_SCHEMA).parquet(path)
    return rows.groupBy("run", "stage", "table").agg(F.max_by("rows", "written_at").alias("rows"))


def status_class(status: str = "status") -> Column:
    """ok / not_found / error from a lookup status string."""
    s = F.col(status)
    return (F.when(s == "ok", F.lit("ok")).when(s == "not_found", F.lit("not_found"))
            .when(s.startswith("error"), F.lit("error")).otherwise(F.lit("other")))


def lookup_status(df: DataFrame, status: str = "status") -> DataFrame:
    """Counts per status class."""
    return df.groupBy(status_class(status).alias("status_class")).agg(F.count(F.lit(1)).alias("n"))


def lookup_errors(df: DataFrame, status: str = "status") -> DataFrame:
    """Per-row list of everything not ok."""
    return df.filter(F.col(status) != "ok")
