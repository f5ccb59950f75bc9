"""Writes: versioned tables, whole-table overwrite, day-partitioned layout, keyed upsert of partitions."""

from tidemark.sinks.tables import (
    overwrite_path,
    overwrite_self,
    overwrite_table,
    probe_target,
    store,
    write_partitioned,
    write_target,
)
from tidemark.sinks.upsert import UpsertResult, publish, recover, upsert_frame, upsert_partitions, write_in_full
from tidemark.sinks.versioned import VersionedTable, layout, ledger_frame, read_published, table_at

__all__ = [
    "UpsertResult",
    "VersionedTable",
    "layout",
    "ledger_frame",
    "overwrite_path",
    "overwrite_self",
    "overwrite_table",
    "probe_target",
    "publish",
    "read_published",
    "recover",
    "store",
    "table_at",
    "upsert_frame",
    "upsert_partitions",
    "write_in_full",
    "write_partitioned",
    "write_target",
]
