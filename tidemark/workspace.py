"""Where intermediate tables live: a folder every executor can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
WAREHOUSE_DIR = "spark.sql.warehouse.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, else one within the warehouse.

    Driver and executors share the warehouse as they share the tables in it. One on a local disk is refused,
    unless driver and executors run on one machine.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if not folder:
        folder = f"{spark.conf.get(WAREHOUSE_DIR)}/_runs"
        if not _is_shared(folder, spark.conf.get("spark.master", "local")):
            raise RuntimeError(f"set {CHECKPOINT_DIR}: the warehouse, {folder}, lies on the driver's own disk")
    return folder.rstrip("/")


def _is_shared(folder: str, master: str) -> bool:
    """Whether executors find what the driver sees in ``folder``."""
    return master.startswith("local") or not folder.startswith(("file:", "/"))


def new_run(spark: SparkSession, name: str) -> str:
    """A path nobody else writes to, for one run of one operator."""
    return f"{shared_folder(spark)}/tidemark/{name}-{uuid.uuid4().hex}"


def remove_run(spark: SparkSession, path: str) -> None:
    """Deletes what a finished run has kept, by the file system that the path names."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)
