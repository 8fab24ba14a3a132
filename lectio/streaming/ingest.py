"""Incremental bronze ingestion of landed feed files (S1 + S5 + O1).

The batch jobs re-read every landed feed each run; on a cluster the same
landing folder is consumed incrementally by a file-source stream. What
belongs to one fetch is decided by the landing, never by how the stream
happens to cut micro-batches: files under ``fetch=<stamp>/`` belong to that
fetch, a file directly in the landing folder to its modification time. Each
micro-batch writes its own part of those batches, named after the query's id
and the micro-batch, so a retry replaces its part, a new checkpoint adds
parts, and no part of another query or batch job is ever touched.

Silver is the newest fetch of every user: users whose feeds arrive in other
micro-batches or fetches stay. It is partitioned by a hash of the user; a
micro-batch reads and replaces the partitions of the users it holds and never
reads bronze, so its cost does not grow with history.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lectio.operators.cleaning import clean_books
from lectio.operators.quality import non_empty
from lectio.schemas import FEED_XML
from lectio.session import scratch_path
from lectio.sources.feed import feed_columns
from lectio.sources.sinks import append_bronze, store_of
from lectio.sources.tables import BATCH, PART

STAMP = "yyyyMMddHHmmssSSSSSS"


#: Partitions of silver, and the columns that only its upkeep needs.
SILVER_PARTS = 64
BUCKET = "_bucket"
UPKEEP = (BATCH, PART, "_file", BUCKET)


def read_silver(spark: SparkSession, silver: str) -> DataFrame:
    """silver_books as the batch stages write it."""
    return spark.read.parquet(silver).drop(*UPKEEP)


def _newest(rows: DataFrame) -> DataFrame:
    """Rows of each user's newest batch. A file that several parts of a
    batch hold (it was ingested again under a new checkpoint) counts once."""
    newest = rows.groupBy(F.col("username").alias("_user")).agg(F.max(BATCH).alias("_newest"))
    parts = rows.groupBy(F.col(BATCH).alias("_of"), F.col("_file").alias("_from")).agg(F.max(PART).alias("_only"))
    own = rows.join(newest, F.col("username").eqNullSafe(F.col("_user")) & (F.col(BATCH) == F.col("_newest")))
    own = own.join(parts, (F.col(BATCH) == F.col("_of")) & F.col("_file").eqNullSafe(F.col("_from")))
    return own.where(F.col("_file").isNull() | (F.col(PART) == F.col("_only"))).select(rows.columns)


def update_silver(rows: DataFrame, silver: str, part: str) -> list[int]:
    """Bring silver up to date with the bronze ``rows`` of a micro-batch;
    returns the partitions that were replaced.

    A micro-batch that is run again replaces what its first run added. The
    new partitions are written to scratch before the old ones are replaced,
    in one job."""
    spark = rows.sparkSession
    bucket = F.pmod(F.xxhash64("username"), F.lit(SILVER_PARTS)).cast("int")
    rows = rows.withColumn(PART, F.lit(part)).withColumn(BUCKET, bucket)
    touched = sorted(r[0] for r in rows.select(BUCKET).distinct().collect())
    if not touched:
        return []
    # rows without a book id end a user's older fetches too, so they are dropped last
    new = clean_books(rows.withColumn("book_id", F.coalesce("book_id", F.lit(""))), snapshot=False, keep_empty=True)
    store, folder = store_of(spark, silver)
    if store.exists(folder):
        old = spark.read.schema(new.schema).parquet(silver).where(F.col(BUCKET).isin(touched) & (F.col(PART) != part))
        new = old.unionByName(new)
    path = scratch_path(spark, "silver-parts")
    _newest(new).where(non_empty("book_id")).write.parquet(path)
    done = spark.read.schema(new.schema).parquet(path)
    filled = {r[0] for r in done.select(BUCKET).distinct().collect()}
    done.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(silver)
    for empty in set(touched) - filled:  # their users' newest fetches have no books
        store.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{silver.rstrip('/')}/{BUCKET}={empty}"), True)
    return touched


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the checkpoint: another one for a new one."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def _writer(bronze: str, source: str, silver: str | None, checkpoint: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        part = f"{_query_id(spark, checkpoint)}-{batch_id:010d}"
        rows = batch.withColumn("_source", F.lit(source))
        append_bronze(rows, bronze, part=part)
        if silver is not None:
            update_silver(rows, silver, part)
    return write


def ingest_feed_stream(spark: SparkSession, landing: str, bronze: str, checkpoint: str,
                       available_now: bool = True, source: str = "rss",
                       max_files_per_trigger: int | None = None,
                       silver: str | None = None) -> StreamingQuery:
    """Start the landing stream; with ``available_now`` it processes every
    file present and stops (schedule it like the batch job).
    ``max_files_per_trigger`` only bounds a micro-batch's size; bronze and
    silver are the same whatever it is. With ``silver`` each micro-batch
    also brings silver_books up to date (read it by :func:`read_silver`)."""
    r = (spark.readStream.format("xml").option("rowTag", "item").option("recursiveFileLookup", "true")
         .option("ignoreSurroundingSpaces", "false").schema(FEED_XML))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = r.load(landing).withColumns({"_file": F.col("_metadata.file_path"), "_landed": F.col("_metadata.file_modification_time")})
    fetch = F.regexp_replace(F.regexp_extract("_file", r"/fetch=([^/]+)/", 1), r"%3A|\D", "")
    stamp = F.when(fetch != "", F.rpad(fetch, 20, "0")).otherwise(F.date_format("_landed", STAMP))
    at = F.regexp_replace(BATCH, r"^(\d{4})(\d\d)(\d\d)(\d\d)(\d\d)(\d\d)(\d{6})$", "$1-$2-$3 $4:$5:$6.$7")
    items = feed_columns(raw, "_file", stamp.alias(BATCH)).withColumn("_ingested_at", F.to_timestamp(at))
    w = items.writeStream.foreachBatch(_writer(bronze, source, silver, checkpoint)).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 minutes")
    return w.start()
