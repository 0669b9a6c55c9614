"""Session helpers: a local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

_LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
_SOURCE_TASKS = "spark.vigilo.sourceTasks"       # the test tables are single row groups



def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "16g", app: str = "vigilo",
                  extra: dict | None = None) -> SparkSession:
    """A local session configured the way the tests and the bench expect."""
    b = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", driver_memory))
    b = b.config(_SOURCE_TASKS, str(cpus if str(cpus).isdigit() else os.cpu_count()))
    for k, v in {**_LOCAL_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by the whole cluster for lineage cuts and staged tables.

    Uses ``spark.checkpoint.dir`` from the session when the cluster names one.
    Only when it is unset on a local master (tests) a scratch folder is created and
    registered, so later calls agree.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        conf_dir = spark.sparkContext.getCheckpointDir()
    if not conf_dir:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("on a cluster spark.checkpoint.dir must name a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="vigilo-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared folder."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


def write_folders(df: DataFrame, path: str, partition_by: Iterable[str] = (), mode: str = "error", open_files: int = 8) -> None:
    """Write parquet, a folder for each value of ``partition_by``.

    Rows go to their folders as they come: a task keeps up to ``open_files`` files open, and sorts its rows by folder
    only from the value on that is one too many (Spark sorts all of them otherwise, and spills). A setting of the session counts instead.
    """
    conf = df.sparkSession.conf
    columns, own = list(partition_by), conf.get(_OPEN_FILES, None)
    w = df.write.mode(mode).option("compression", "zstd")
    if not columns or own is not None:
        (w.partitionBy(*columns) if columns else w).parquet(path)
        return
    conf.set(_OPEN_FILES, str(open_files))
    try:
        w.partitionBy(*columns).parquet(path)
    finally:
        conf.unset(_OPEN_FILES)


def stage(df, name: str):
    """Write ``df`` as a parquet table in the shared folder and read it back.

    Used where one intermediate feeds several consumers (a plan that Catalyst
    would otherwise prune differently per consumer and recompute from the
    scans). The write is a normal fault-tolerant job; the read-back carries
    exact size statistics for adaptive planning and has a short lineage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
