"""Table scans (S3) and the declared-schema row builder."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


def read_table(spark: SparkSession, name_or_path: str, base: str | None = None) -> DataFrame:
    """A catalog table by name, or ``<base>/<name>.parquet``."""
    if base is None:
        return spark.table(name_or_path)
    return spark.read.parquet(os.path.join(base, f"{name_or_path}.parquet"))


BATCH, PART = "_batch", "_part"


def read_bronze(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The whole bronze history written by
    :func:`lectio.sources.sinks.append_bronze`, widened schemas merged.
    With the declared ``schema`` no footer is opened; columns beyond it are
    left out."""
    if schema is not None:
        both = StructType([*schema.fields, StructField(BATCH, StringType()), StructField(PART, StringType())])
        return spark.read.schema(both).parquet(path)
    return spark.read.option("mergeSchema", "true").parquet(path)


def newest_batch(spark: SparkSession, path: str) -> str | None:
    """Name of the newest batch folder, from the folder listing alone."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(folder):
        return None
    names = [s.getPath().getName() for s in store.listStatus(folder) if s.isDirectory()]
    return max((n for n in names if n.startswith(f"{BATCH}=")), default=None)


def latest_bronze(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Newest batch of a bronze folder. Older batches are neither scanned
    nor opened: the batch is found in the listing and only its folder is
    read, so the cost does not grow with history. Columns that the batch
    has beyond ``schema`` are kept; an empty folder gives an empty frame of
    ``schema``."""
    newest = newest_batch(spark, path)
    if newest is None:
        if schema is None:
            raise ValueError(f"{path} holds no batch yet: pass the declared schema")
        return spark.createDataFrame([], schema)
    df = spark.read.option("mergeSchema", "true").parquet(f"{path.rstrip('/')}/{newest}").drop(PART)
    missing = [f for f in (schema.fields if schema is not None else []) if f.name not in df.columns]
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}) if missing else df


def rows_to_frame(spark: SparkSession, rows: list[dict], schema: StructType) -> DataFrame:
    """Small literal rows against a declared schema (tests, fixtures)."""
    return spark.createDataFrame(rows, schema=schema)
