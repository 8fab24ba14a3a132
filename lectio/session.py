"""Session helpers: building a session for tests/bench and locating the
shared checkpoint folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every lectio job wants; cluster-level values win when already set.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpointed frames' files are removed once the frame is collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[8]", app: str = "lectio",
                  shuffle_partitions: int | None = 8, event_log_dir: str | None = None,
                  **conf: str) -> SparkSession:
    """Local session for tests and the bench. On a cluster use the
    provided session instead and only call :func:`checkpoint_dir`.
    ``event_log_dir`` writes Spark's event log (stage and task timings)
    there, for offline analysis without the UI."""
    b = SparkSession.builder.master(master).appName(app)
    if event_log_dir:
        os.makedirs(event_log_dir, exist_ok=True)
        b = b.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", conf.pop("driver_memory", "8g"))
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder, read from the session. Only a local
    master may leave it unset (tests); a cluster that names none is an
    error, because every executor would write to its own disk."""
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all "
                             f"executors share (master is {sc.master})")
        d = tempfile.mkdtemp(prefix="lectio-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint location for
    intermediate tables written to cut lineage (survives executor loss,
    unlike local checkpoints). It is removed when the driver ends, so a
    lazy frame over it stays readable for the life of the session."""
    path = "/".join([checkpoint_dir(spark).rstrip("/"), "lectio", f"{name}-{uuid.uuid4().hex}"])
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, an execution's shuffle files are removed as it ends; by
    themselves they stay until the driver happens to collect garbage. For
    writing a frame that is read from its files from then on."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
