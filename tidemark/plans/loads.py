"""Loads of raw deliveries into tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession

from tidemark.operators.metrics import count_rows
from tidemark.operators.schema_ops import compare_schemas, harmonize_schema
from tidemark.operators.staging import STAMP, stamp_ingested_at, strip_metadata
from tidemark.schemas import METADATA_COLUMNS
from tidemark.sinks.tables import probe_target, write_target
from tidemark.sources.parquet import read_delivery


@dataclass(frozen=True)
class LoadResult:
    """Row counts before and after the transformation, and the schema differences met."""

    target: str
    rows_read: int
    rows_written: int
    discrepancies: list[str] = field(default_factory=list)


def raw_load(
    spark: SparkSession,
    path: str,
    target: str,
    as_of: datetime | str | Column | None = None,
    drop_columns: Sequence[str] = METADATA_COLUMNS,
    fmt: str = "parquet",
) -> LoadResult:
    """Scan a delivery with all its files' columns, drop connector columns, stamp it, overwrite the table."""
    source = read_delivery(spark, path)
    return _write_counted(source, lambda df: stamp_ingested_at(strip_metadata(df, drop_columns), as_of), target, fmt)


def evolving_load(
    spark: SparkSession,
    path: str,
    target: str,
    as_of: datetime | str | Column | None = None,
    fmt: str = "parquet",
) -> LoadResult:
    """Overwrite the table with a delivery, in the shape of the live table where the two differ.

    Without a live table the delivery's own shape is taken. The stamp of an earlier load is no difference.
    """
    incoming = read_delivery(spark, path)
    production = probe_target(spark, target, fmt)
    discrepancies = [] if production is None else compare_schemas(incoming.drop(STAMP), production.drop(STAMP))

    def transform(df: DataFrame) -> DataFrame:
        return stamp_ingested_at(harmonize_schema(df, production) if discrepancies else df, as_of)

    return _write_counted(incoming, transform, target, fmt, discrepancies)


def _write_counted(source: DataFrame, transform, target: str, fmt: str, discrepancies: Sequence[str] = ()) -> LoadResult:
    """One job: both counts are taken while the rows are written."""
    counted, read = count_rows(source, "read")
    result, written = count_rows(transform(counted), "written")
    write_target(result, target, fmt)
    return LoadResult(target, read.get["rows"], written.get["rows"], list(discrepancies))
