"""Full-refresh writes. A target holding a ``/`` is a path, any other a table name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

from tidemark.functions import column
from tidemark.sources.parquet import probe_path, probe_table, read_parquet
from tidemark.workspace import new_run


def overwrite_table(df: DataFrame, table: str, fmt: str = "parquet") -> str:
    """Replace a catalog table, its schema included."""
    df.write.format(fmt).mode("overwrite").saveAsTable(table)
    return table


def overwrite_path(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Replace what is stored at ``path``, which ``df`` must not read; see ``overwrite_self``."""
    df.write.format(fmt).mode("overwrite").save(path)
    return path


def store(df: DataFrame, path: str) -> DataFrame:
    """Write a frame once and go on with the copy.

    For results used several times, and for small ones the planner could not know to be small. The copy
    is in the shared folder, so it survives the loss of executors.
    """
    return read_parquet(df.sparkSession, overwrite_path(df, path), schema=df.schema)


def overwrite_self(df: DataFrame, path: str, run: str | None = None) -> str:
    """Replace ``path`` by a frame that reads it.

    Spark removes the old files before the new ones are complete, so the frame is written to the shared
    folder first. That copy stays, and the second step can be repeated from it.
    """
    return overwrite_path(store(df, run or new_run(df.sparkSession, "overwrite")), path)


def write_target(df: DataFrame, target: str, fmt: str = "parquet") -> str:
    return overwrite_path(df, target, fmt) if "/" in target else overwrite_table(df, target, fmt)


def probe_target(spark: SparkSession, target: str, fmt: str = "parquet") -> DataFrame | None:
    return probe_path(spark, target, fmt) if "/" in target else probe_table(spark, target)


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: str,
    cluster_by: Sequence[str] = (),
    replace_all: bool = True,
) -> str:
    """Write one folder per value of ``partition_by``, files sorted by ``cluster_by``.

    The rebalance brings a day's rows together without being bound to one task per day: adaptive
    execution splits a large day over several tasks and joins small ones. Sorting inside the tasks keeps
    the row-group statistics of the cluster columns narrow, so filters on them skip row groups.
    ``replace_all=False`` replaces only the partitions that ``df`` has rows for.
    """
    writer = arrange(df, partition_by, cluster_by).write.partitionBy(partition_by).mode("overwrite")
    _overwrite_mode(writer, replace_all).parquet(path)
    return path


def arrange(df: DataFrame, partition_by: str, cluster_by: Sequence[str] = ()) -> DataFrame:
    order = [column(c) for c in (partition_by, *cluster_by)]
    return df.hint("rebalance", column(partition_by)).sortWithinPartitions(*order)


def _overwrite_mode(writer: DataFrameWriter, replace_all: bool) -> DataFrameWriter:
    return writer.option("partitionOverwriteMode", "static" if replace_all else "dynamic")
