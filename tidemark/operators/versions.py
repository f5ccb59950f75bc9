"""Reducing a change log to one current row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidemark.functions import quoted
from tidemark.schemas import DELETED_AT, EXTRACTED_AT, LSN, RAW_ID, UPDATED_AT, Entity

#: newest first: log position, then extraction time; the raw id settles exact ties
VERSION_ORDER = (LSN, EXTRACTED_AT, RAW_ID)

_RANK = "__version_rank"


def live_rows(df: DataFrame, deleted_at: str = DELETED_AT) -> DataFrame:
    """Rows that are not tombstones."""
    return df.where(f"{quoted(deleted_at)} is null")


def latest_by_key(
    df: DataFrame,
    keys: str | Sequence[str],
    order: Sequence[str] = VERSION_ORDER,
    tombstones: str | None = "filter_first",
) -> DataFrame:
    """Latest version of each key.

    ``filter_first`` drops tombstones before ranking, so a deleted key comes back with its last live
    version. ``rank_first`` ranks all versions and then drops keys whose latest one is a tombstone.
    ``None`` keeps tombstones. Rows with a null key count as one key.

    Each scan task keeps one row per key before the shuffle (a partial ``WindowGroupLimit``), so a key
    that holds a large share of the log reaches its task as at most one row per scan task.
    """
    if tombstones not in ("filter_first", "rank_first", None):
        raise ValueError(f"unknown tombstone policy {tombstones!r}")
    keys = [keys] if isinstance(keys, str) else list(keys)
    partition = ", ".join(map(quoted, keys))
    newest_first = ", ".join(f"{quoted(c)} desc" for c in order)
    source = live_rows(df) if tombstones == "filter_first" else df
    ranked = source.selectExpr("*", f"row_number() over (partition by {partition} order by {newest_first}) as {_RANK}")
    latest = ranked.where(f"{_RANK} = 1").drop(_RANK)
    return live_rows(latest) if tombstones == "rank_first" else latest


def current_rows(staged: DataFrame, entity: Entity, tombstones: str = "filter_first") -> DataFrame:
    """Current state of an entity: business columns and the two clocks under their mart names."""
    return project_current(latest_by_key(staged, entity.key, tombstones=tombstones), entity)


def project_current(latest: DataFrame, entity: Entity) -> DataFrame:
    return latest.selectExpr(
        *map(quoted, entity.current),
        f"{UPDATED_AT} as last_updated_at",
        f"{EXTRACTED_AT} as ingested_at",
    )
