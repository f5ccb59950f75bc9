"""Incremental load driven by the files that have landed, instead of by high-water marks.

The file source remembers which files it has read, so a version that arrives late, below both marks, is
picked up as well.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemark.functions import quoted
from tidemark.operators.marks import INGESTED_CLOCK, UPDATED_CLOCK
from tidemark.operators.staging import stage
from tidemark.operators.versions import latest_by_key, live_rows, project_current
from tidemark.schemas import Entity
from tidemark.sinks.tables import store
from tidemark.sinks.versioned import VersionedTable
from tidemark.workspace import new_run, remove_run

CLOCKS = (UPDATED_CLOCK, INGESTED_CLOCK)


def upsert_arrivals(
    spark: SparkSession,
    landing: str,
    schema: StructType,
    entity: Entity,
    facts: Callable[[DataFrame], DataFrame],
    target: str,
    partition_by: str,
    checkpoint: str,
    cluster_by: Sequence[str] = (),
    timestamp_type: str = "timestamp",
) -> None:
    """Bring ``target`` up to date with all files in ``landing``, then return.

    ``facts`` turns current rows into rows of the target. Beside the target, ``<target>.state`` keeps the latest
    live version of each key, bucketed by key: a micro-batch is ranked against the versions of its own keys alone,
    and only files that may hold one of them are opened, not all that ever landed. Both are versioned tables. A
    batch repeated after a failure is known by its name in their ledgers, so it is applied once.
    """
    state = VersionedTable(spark, f"{target.rstrip('/')}.state", entity.key)
    table = VersionedTable(spark, target, entity.key, partition_by, cluster_by, CLOCKS)

    def load(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        run = new_run(session, "arrived")
        # A checkpoint made anew counts its batches from zero again, but under another name.
        name = f"{json.loads(session.read.text(f'{checkpoint}/metadata').first()[0])['id']}/{batch_id}"
        arrived = store(latest_by_key(live_rows(stage(batch, entity, timestamp_type)), entity.key), run)
        keys = arrived.selectExpr(quoted(entity.key))
        if state.head() is None:
            state.replace(arrived, name)
        else:
            known = state.rows_of(keys.where(f"{quoted(entity.key)} is not null"))
            state.upsert(latest_by_key(known.unionByName(arrived), entity.key), name)
        rows = facts(project_current(state.rows_of(keys), entity))
        if table.head() is None:
            table.replace(rows, name)
        else:
            table.upsert(rows, name)
        remove_run(session, run)

    (
        spark.readStream.schema(schema)
        .parquet(landing)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
