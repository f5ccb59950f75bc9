"""What the operators share: stored intermediate tables, row keys, views of Arrow text columns."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from tidemark.functions import column
from tidemark.sinks.tables import store
from tidemark.workspace import new_run

#: Bytes of text that one numpy pass takes at a time.
PIECE = 1 << 20
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder; cuts its lineage and survives lost executors."""
    return store(df, new_run(df.sparkSession, f"llm-{name}"))


def find_package(spark: SparkSession) -> None:
    """Lets Python workers import this package where it lies, for sessions that were not submitted with it."""
    environment, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs that run meanwhile hand at most ``rows`` rows at a time to Python workers.

    A batch lies whole in Arrow's buffers outside the heap, in the JVM and in the worker, and Spark's 10,000 rows of
    long texts or sets are many megabytes. The session's own setting returns afterwards.
    """
    before = spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, rows if int(before) <= 0 else min(rows, int(before)))
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not use in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_keys(df: DataFrame) -> tuple[Column, Column]:
    """Two 64-bit hashes over all columns but maps: rows that agree in both are copies of one row."""
    columns = [column(f.name) for f in df.schema if not isinstance(f.dataType, MapType)]
    return F.xxhash64(F.lit(1), *columns), F.xxhash64(*columns, F.lit(2))


def one_of_each(df: DataFrame) -> tuple[DataFrame, str, str]:
    """One row of each set of repeated rows, with two key columns added; copies collapse before the shuffle."""
    first, second = fresh(df, "_key1"), fresh(df, "_key2")
    keys = row_keys(df)
    return df.withColumns({first: keys[0], second: keys[1]}).dropDuplicates([first, second]), first, second


def utf8(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a text or binary column without copying; a null counts as empty."""
    if values.null_count:
        values = values.fill_null("" if not pa.types.is_binary(values.type) else b"")
    wide = pa.types.is_large_string(values.type) or pa.types.is_large_binary(values.type)
    _, offsets, data = values.buffers()
    if offsets is None or not len(values):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    kind = np.int64 if wide else np.int32
    bounds = np.frombuffer(offsets, kind, len(values) + 1, values.offset * np.dtype(kind).itemsize)
    return bounds.astype(np.int64), np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def texts(values: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each row; a null is empty."""
    bounds, data = utf8(values)
    for i in range(len(bounds) - 1):
        yield data[bounds[i] : bounds[i + 1]].tobytes()


def pieces(bounds: np.ndarray, data: np.ndarray, limit: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """All bytes in pieces of about ``limit``: the bytes, where rows start in them, and which rows these are.

    Short rows share a piece. A longer row is cut into several, each at a space if there is one.
    """
    row, rows = 0, len(bounds) - 1
    while row < rows:
        last = max(row + 1, int(np.searchsorted(bounds, bounds[row] + limit, "right")) - 1)
        low, high = int(bounds[row]), int(bounds[last])
        if high - low <= limit:
            yield data[low:high], bounds[row:last] - low, np.arange(row, last)
        else:
            while low < high:
                cut = min(low + limit, high)
                if cut < high:
                    blanks = np.flatnonzero(data[low:cut] == 32)
                    cut = low + int(blanks[-1]) + 1 if len(blanks) else cut
                yield data[low:cut], np.zeros(1, np.int64), np.array([row])
                low = cut
        row = last


def bounded_ids(ids: DataFrame, name: str, most: int) -> DataFrame:
    """At most ``most`` of the ids, picked by their hash, so that reruns pick the same."""
    return ids.orderBy(F.xxhash64(column(name), F.lit("sample")), column(name)).limit(most)
