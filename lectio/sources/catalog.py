"""DDL helpers (S11), tables that are switched (O2) and batches that become
visible as catalog partitions (O1)."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lectio.sources.tables import BATCH


def ensure_schema(spark: SparkSession, db: str, comment: str | None = None, location: str | None = None) -> list[str]:
    """CREATE DATABASE IF NOT EXISTS, then the tables it holds."""
    if not db.replace("_", "").isalnum():
        raise ValueError(f"bad database name {db!r}")
    stmt = f"CREATE DATABASE IF NOT EXISTS {db}"
    if comment:
        stmt += " COMMENT '" + comment.replace("'", "''") + "'"
    if location:
        stmt += f" LOCATION '{_quoted(location)}'"
    spark.sql(stmt)
    return [t.name for t in spark.catalog.listTables(db)]


def register_table(spark: SparkSession, name: str, path: str, refresh: bool = True) -> None:
    """Expose a stage's table folder under a catalog name
    (``db.table``), so it is read with ``spark.table(name)`` (S3); the
    catalog entry points at the files, nothing is copied. ``refresh``
    re-lists the files after a stage replaced them."""
    parts = name.split(".")
    if not all(p.replace("_", "").isalnum() for p in parts) or len(parts) > 2:
        raise ValueError(f"bad table name {name!r}")
    if len(parts) == 2:
        ensure_schema(spark, parts[0])
    location = path.replace("'", "''")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{location}'")
    if refresh:
        spark.catalog.refreshTable(name)


def is_table_name(name: str) -> bool:
    """``table`` or ``db.table``; anything else is a path."""
    return re.fullmatch(r"\w+(\.\w+)?", name) is not None


def table_folder(spark: SparkSession, name: str, version: str) -> str:
    """A folder of its own for a version of a table, below its database's."""
    db, _, table = name.rpartition(".")
    db = db or spark.catalog.currentDatabase()
    ensure_schema(spark, db)
    return f"{spark.catalog.getDatabase(db).locationUri.rstrip('/')}/{table}-versions/{version}"


def _quoted(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")


def switch_table(spark: SparkSession, name: str, folder: str) -> None:
    """Make ``name`` read ``folder`` by one catalog operation. A table whose
    columns stay gets another location, a table whose columns change becomes
    a new table. Earlier folders stay until :func:`drop_versions`, so queries
    that have begun end on the files they began with."""
    if spark.catalog.tableExists(name) and spark.table(name).schema.simpleString() == spark.read.parquet(folder).schema.simpleString():
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{_quoted(folder)}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: its files stay
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{_quoted(folder)}'")
    spark.catalog.refreshTable(name)


def table_location(spark: SparkSession, name: str) -> str:
    return next(r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect() if r.col_name == "Location")


def drop_versions(spark: SparkSession, name: str) -> int:
    """Delete the folders that a switched table no longer reads."""
    current = table_location(spark, name).rstrip("/").rsplit("/", 1)
    path = spark._jvm.org.apache.hadoop.fs.Path(current[0])
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    old = [s.getPath() for s in store.listStatus(path) if s.getPath().getName() != current[1]]
    for folder in old:
        store.delete(folder, True)
    return len(old)


def append_batch(df: DataFrame, name: str, batch: str) -> None:
    """O1: append a batch to a catalog table partitioned by batch.

    The rows are written to a folder that the table does not know; the batch
    becomes visible, whole, when its partition is added. A batch that failed
    half-way is never seen, and one that is written again takes the place of
    its first writing. Columns the table does not have yet are added to it
    (older batches read null)."""
    spark = df.sparkSession
    if not re.fullmatch(r"\w+", batch):
        raise ValueError(f"bad batch name {batch!r}")
    folder = table_folder(spark, name, f"{BATCH}={batch}-{uuid.uuid4().hex}")
    df.write.parquet(folder)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE {name} ({columns}, {BATCH} string) USING parquet PARTITIONED BY ({BATCH}) "
                  f"LOCATION '{_quoted(table_folder(spark, name, 'root'))}'")
    have = {c.lower() for c in spark.table(name).columns}
    new = [f for f in df.schema if f.name.lower() not in have]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in new)})")
    if batch in batches(spark, name):
        spark.sql(f"ALTER TABLE {name} PARTITION ({BATCH}='{batch}') SET LOCATION '{_quoted(folder)}'")
    else:
        spark.sql(f"ALTER TABLE {name} ADD PARTITION ({BATCH}='{batch}') LOCATION '{_quoted(folder)}'")
    spark.catalog.refreshTable(name)


def batches(spark: SparkSession, name: str) -> list[str]:
    """The visible batches, from the partition metadata alone, oldest first."""
    return sorted(r.partition.split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {name}").collect())


def latest_of(spark: SparkSession, name: str, schema: StructType | None = None) -> DataFrame:
    """The newest batch of a table of :func:`append_batch`: no folder is
    listed but that partition's. A table without batches gives no rows."""
    if not spark.catalog.tableExists(name):
        if schema is None:
            raise ValueError(f"{name} holds no batch yet: pass the declared schema")
        return spark.createDataFrame([], schema)
    found = batches(spark, name)
    return spark.table(name).where(F.col(BATCH) == F.lit(found[-1] if found else None)).drop(BATCH)
