"""Sinks (O1, O2): append-only bronze with schema evolution, overwrite for
silver/gold."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectio.sources.catalog import is_table_name, switch_table, table_folder
from lectio.sources.tables import BATCH, PART


def append_bronze(df: DataFrame, path: str, batch_col: str = BATCH, part: str = "batch") -> None:
    """O1: append one batch to a parquet folder partitioned by batch and
    part of the batch.

    Each batch lands in its own folder, so a batch that adds a column never
    conflicts with older files, and the newest batch is found by listing.
    ``part`` tells writers of the same batch apart (a stream's micro-batches).
    The write replaces only its own (batch, part) folder (dynamic partition
    overwrite): nothing older is ever touched, and re-running a failed or
    retried batch with the same stamp cannot duplicate rows."""
    if batch_col not in df.columns:
        df = df.withColumn(batch_col, F.date_format("_ingested_at", "yyyyMMddHHmmssSSSSSS"))
    (df.withColumn(PART, F.lit(part)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(batch_col, PART).parquet(path))


def store_of(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path in it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def overwrite_table(df: DataFrame, path_or_table: str, sort_within: tuple[str, ...] = ()) -> None:
    """O2: replace the table (schema included). ``sort_within`` orders rows
    inside each file for min/max skipping; no global sort.

    The rows are written to a fresh folder first; a job that fails leaves the
    old table as it was. A catalog name is then switched to the new folder by
    one catalog operation, so every reader sees the old table or the new one.
    A path takes the fresh folder's place by renames: readers of a path
    should not read at that moment."""
    spark = df.sparkSession
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    if is_table_name(path_or_table):
        fresh = table_folder(spark, path_or_table, uuid.uuid4().hex)
        df.write.parquet(fresh)
        switch_table(spark, path_or_table, fresh)
        return
    path = path_or_table.rstrip("/")
    fresh, old = f"{path}.new-{uuid.uuid4().hex}", f"{path}.old-{uuid.uuid4().hex}"
    df.write.parquet(fresh)
    store, target = store_of(spark, path)
    _, written = store_of(spark, fresh)
    _, aside = store_of(spark, old)
    if store.exists(target) and not store.rename(target, aside):
        raise OSError(f"{path} could not be moved aside; the new rows are in {fresh}")
    if not store.rename(written, target):
        store.rename(aside, target)
        raise OSError(f"{fresh} could not take the place of {path}")
    store.delete(aside, True)
