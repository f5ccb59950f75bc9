"""Keyed upsert into a day-partitioned parquet folder, rewriting only the days it touches."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType

from tidemark.functions import column
from tidemark.operators.metrics import count_rows
from tidemark.sinks import journal
from tidemark.sinks.tables import overwrite_path, store, write_partitioned
from tidemark.sources.parquet import read_parquet
from tidemark.workspace import new_run, remove_run

# Fixed value: folder name Spark gives the null partition.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class UpsertResult:
    """Rows in the increment, days rewritten, and days left without rows."""

    rows: int
    rewritten: tuple[date | None, ...]
    emptied: tuple[date | None, ...]


def upsert_frame(target: DataFrame, delta: DataFrame, key: str) -> DataFrame:
    """Target rows whose key ``delta`` lacks, and all of ``delta``. Null keys replace nothing."""
    kept = target.join(delta.select(column(key)), key, "left_anti")
    return kept.select(*[column(c) for c in delta.columns]).unionByName(delta)


def upsert_partitions(
    spark: SparkSession,
    target: str,
    delta: DataFrame,
    key: str,
    partition_by: str,
    cluster_by: Sequence[str] = (),
) -> UpsertResult:
    """Replace or add the rows of ``delta`` by ``key``; its keys must be unique.

    A row may move to another day, so the days to rewrite are those the increment's keys are stored under
    now and those they go to. Only these are read in full. Their new content goes to the shared folder
    first, without layout, and from there into the target: it is not overwritten while it is being read.
    A record beside the target names that copy while the target is being changed, so that ``recover`` can
    finish a publish that was cut off; the copy goes once all is in place. After a full write that was cut off
    this raises, as the rows it did not place are not stored anywhere.
    """
    if not recover(spark, target):
        raise RuntimeError(f"a full write of {target} was cut off: it holds only some of its rows and has to be written again")
    if not isinstance(delta.schema[partition_by].dataType, DateType):
        raise TypeError(f"{partition_by} must be a date")
    run = new_run(spark, "upsert")
    schema = delta.schema

    # The increment is used four times below.
    counted, rows = count_rows(delta, "delta")
    delta = store(counted, f"{run}/delta")
    delta_rows = rows.get["rows"]
    if delta_rows == 0:
        remove_run(spark, run)
        return UpsertResult(0, (), ())
    stored = _read_target(spark, target, schema)

    keys = delta.select(column(key))
    old_days = stored.select(column(key), column(partition_by)).join(keys, key, "left_semi").select(column(partition_by))
    affected = _days(old_days.union(delta.select(column(partition_by))), partition_by)

    # A literal list prunes the other partitions while planning. It is no longer than the list of
    # partition folders, which the driver holds for any read of the target.
    rewritten = upsert_frame(stored.where(_is_day(partition_by, affected)), delta, key)
    overwrite_path(rewritten, f"{run}/rewritten")
    days = [day if day is None else day.isoformat() for day in affected]
    record = {"run": run, "schema": schema.json(), "partition_by": partition_by, "cluster_by": list(cluster_by), "days": days}
    journal.begin(spark, target, record)
    emptied = publish(spark, run, target, schema, partition_by, cluster_by, affected)
    journal.end(spark, target)
    remove_run(spark, run)
    return UpsertResult(delta_rows, affected, emptied)


def recover(spark: SparkSession, target: str) -> bool:
    """Finish a publish that was cut off; ``False`` if it was a full write, which has to be made again."""
    record = journal.pending(spark, target)
    if record is None:
        return True
    if record.get("full"):
        return False
    schema = StructType.fromJson(json.loads(record["schema"]))
    days = tuple(day if day is None else date.fromisoformat(day) for day in record["days"])
    publish(spark, record["run"], target, schema, record["partition_by"], record["cluster_by"], days)
    journal.end(spark, target)
    remove_run(spark, record["run"])
    return True


def write_in_full(df: DataFrame, target: str, partition_by: str, cluster_by: Sequence[str] = ()) -> str:
    """Replace the whole target; one that was cut off does not count as loaded."""
    journal.begin(df.sparkSession, target, {"full": True})
    write_partitioned(df, target, partition_by, cluster_by)
    journal.end(df.sparkSession, target)
    return target


def publish(
    spark: SparkSession,
    run: str,
    target: str,
    schema: StructType,
    partition_by: str,
    cluster_by: Sequence[str],
    affected: Sequence[date | None],
) -> tuple[date | None, ...]:
    """Put the new content of a run's days in place of the target's. May be repeated."""
    rewritten = _read_target(spark, f"{run}/rewritten", schema)
    write_partitioned(rewritten, target, partition_by, cluster_by, replace_all=False)
    filled = set(_days(rewritten, partition_by))
    emptied = tuple(day for day in affected if day not in filled)
    # A dynamic overwrite leaves days without new rows as they were; each gets an empty file instead.
    nothing = spark.createDataFrame([], StructType([f for f in schema if f.name != partition_by]))
    for day in emptied:
        folder = NULL_PARTITION if day is None else day.isoformat()
        overwrite_path(nothing, f"{target}/{partition_by}={folder}")
    return emptied


def _read_target(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return read_parquet(spark, path, schema=schema).select(*[column(name) for name in schema.names])


def _days(df: DataFrame, name: str) -> tuple[date | None, ...]:
    """Distinct days of a frame: at most one per calendar day, so the list is small by nature."""
    found = [row[0] for row in df.select(column(name)).distinct().collect()]
    return tuple(sorted(found, key=lambda day: (day is not None, day)))


def _is_day(name: str, days: Sequence[date | None]) -> Column:
    match = column(name).isin(*[day for day in days if day is not None])
    return match | column(name).isNull() if None in days else match
