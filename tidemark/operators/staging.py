"""From raw text to typed staging frames."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import quoted
from tidemark.schemas import METADATA_COLUMNS, TIMESTAMP, Entity

STAMP = "ingested_at"


def strip_metadata(df: DataFrame, columns: Sequence[str] = METADATA_COLUMNS) -> DataFrame:
    """Drop the listed connector columns; names the frame lacks are ignored."""
    return df.drop(*columns)


def stamp_ingested_at(df: DataFrame, as_of: datetime | str | Column | None = None, name: str = STAMP) -> DataFrame:
    """Add the load time: ``as_of``, or the time the query runs."""
    if as_of is None:
        stamp = F.current_timestamp()
    elif isinstance(as_of, Column):
        stamp = as_of
    else:
        stamp = F.lit(as_of).cast("timestamp")
    return df.withColumn(name, stamp)


def stage(raw: DataFrame, entity: Entity, timestamp_type: str = "timestamp") -> DataFrame:
    """Cast and rename a raw log into its staged form.

    Under ANSI mode, Spark's default, text that cannot be cast fails the query; ``quarantine`` has the
    tolerant form. ``timestamp_type`` may be ``timestamp_ntz`` for logs without zones.
    """
    return raw.selectExpr(*[_staged(c, timestamp_type) for c in entity.columns])


def cast_of(declared: str, timestamp_type: str) -> str:
    return timestamp_type if declared == TIMESTAMP else declared


def _staged(declared: schemas.Column, timestamp_type: str) -> str:
    raw = quoted(declared.raw)
    value = f"cast({raw} as {cast_of(declared.cast, timestamp_type)})" if declared.cast else raw
    return f"{value} as {quoted(declared.staged)}"
