"""Runs a registered query and its SQL side by side."""

from __future__ import annotations

import datetime
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def duckdb_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def _plain(value):
    if value is None:
        return ""
    if isinstance(value, datetime.datetime):
        return value.isoformat(sep=" ", timespec="microseconds")
    return repr(value)


def normal_rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """``None`` if both give the same columns and rows, else what differs."""
    result = connection.execute(sql)
    expected_columns = [d[0] for d in result.description]
    if sorted(df.columns) != sorted(expected_columns):
        return f"columns {sorted(df.columns)} against {sorted(expected_columns)}"
    expected = normal_rows(expected_columns, result.fetchall())
    found = normal_rows(df.columns, [tuple(row) for row in df.collect()])
    if expected != found:
        only_found = sorted(set(found) - set(expected))[:2]
        only_expected = sorted(set(expected) - set(found))[:2]
        return f"{len(found)} rows against {len(expected)}; only in Spark {only_found}; only in SQL {only_expected}"
    return None
