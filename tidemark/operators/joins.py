"""Outer lookups and the frame-level upsert."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from tidemark.functions import column, quoted, same_name, spread_nulls, typed_null

_SPREAD = "__spread"
_LOOKUP_SPREAD = "__lookup_spread"
_LOOKUP = "__lookup_"
_UPDATE = "__update_"


def left_lookup(
    rows: DataFrame,
    lookup: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
    spread_by: Sequence[str],
) -> DataFrame:
    """Left outer equi join: ``on`` maps row columns to lookup keys, ``take`` lookup columns to new names.

    Nothing is broadcast by force: a small lookup is turned into a broadcast by Spark's own size check.
    Beyond it both sides are shuffled on the key and ``spread_nulls``. That second key scatters rows
    without a key by ``spread_by``, and makes both join inputs fresh exchanges, which is the shape in
    which adaptive execution splits the tasks of a hot key.
    """
    right = lookup.selectExpr(
        *[f"{quoted(key)} as {quoted(_LOOKUP + key)}" for key in on.values()],
        f"{spread_nulls(list(on.values()), list(on.values()))} as {_LOOKUP_SPREAD}",
        *[f"{quoted(name)} as {quoted(new)}" for name, new in take.items()],
    )
    left = rows.selectExpr("*", f"{spread_nulls(list(on), spread_by)} as {_SPREAD}")
    match = [f"{quoted(row_key)} = {quoted(_LOOKUP + key)}" for row_key, key in on.items()]
    match.append(f"{_SPREAD} = {_LOOKUP_SPREAD}")
    joined = left.join(right, F.expr(" and ".join(match)), "left")
    return joined.drop(_SPREAD, _LOOKUP_SPREAD, *[_LOOKUP + key for key in on.values()])


def enrich_transactions(transactions: DataFrame, accounts: DataFrame) -> DataFrame:
    """Add the owners of the sending and the receiving account; unmatched ones stay null."""
    owners = accounts.select("account_id", "user_id")
    spread_by = ["transaction_id"]
    sent = left_lookup(transactions, owners, {"from_account_id": "account_id"}, {"user_id": "from_user_id"}, spread_by)
    return left_lookup(sent, owners, {"to_account_id": "account_id"}, {"user_id": "to_user_id"}, spread_by)


def merge_upsert(main: DataFrame, update: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Update ``main`` from ``update`` and add the rows only ``update`` has.

    A null never overwrites a value; columns only ``update`` has are dropped; null keys match nothing;
    several updates of one key each give a row, so reduce ``update`` with ``latest_by_key`` first. Names
    match as the session resolves them and come out as ``main`` writes them. Both frames are read more
    than once, so store those that are costly to compute.

    The full outer join this amounts to is written as a left join plus the unmatched updates. A full
    outer join always shuffles all of ``main`` and cannot split a hot key. The left join lets Spark
    broadcast an update it finds small, and adaptive execution split a hot key otherwise.
    """
    fold = same_name(main.sparkSession)
    known = {fold(c): c for c in main.columns}
    keys = [known[fold(k)] for k in keys]
    named = {fold(c): c for c in update.columns}
    shared = [c for c in main.columns if fold(c) in named]
    update = update.selectExpr(*[f"{quoted(named[fold(c)])} as {quoted(c)}" for c in shared])
    changed_keys = [_UPDATE + k for k in keys]
    changes = update.selectExpr(*[f"{quoted(c)} as {quoted(_UPDATE + c)}" for c in shared])
    changes = changes.selectExpr("*", f"{spread_nulls(changed_keys, changed_keys)} as {_LOOKUP_SPREAD}")
    match = [f"{quoted(k)} = {quoted(_UPDATE + k)}" for k in keys] + [f"{_SPREAD} = {_LOOKUP_SPREAD}"]
    merged = (
        main.selectExpr("*", f"{spread_nulls(keys, _hashable(main))} as {_SPREAD}")
        .join(changes, F.expr(" and ".join(match)), "left")
        .selectExpr(
            *[
                f"coalesce({quoted(_UPDATE + c)}, {quoted(c)}) as {quoted(c)}" if c in shared else quoted(c)
                for c in main.columns
            ]
        )
    )
    added = _without_match(main, update, keys).select(
        *[
            (column(c) if c in shared else typed_null(main.schema[c].dataType)).alias(c)
            for c in main.columns
        ]
    )
    return merged.union(added)


def _hashable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if not isinstance(f.dataType, MapType)]


def _without_match(main: DataFrame, update: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``update`` whose key ``main`` lacks.

    The keys of ``main`` are reduced to one row each before they are shuffled, and only those that
    ``update`` has go on, so a small result can be broadcast. Updates without a key match nothing: they
    are scattered by a hash of the row, and a hot key's updates are split as in ``left_lookup``.
    """
    names = [quoted(k) for k in keys]
    complete = " and ".join(f"{name} is not null" for name in names)
    wanted = update.where(complete).selectExpr(*names).distinct()
    found = main.where(complete).selectExpr(*names).distinct().join(wanted, list(keys), "left_semi")
    found = found.selectExpr(
        *[f"{quoted(k)} as {quoted(_LOOKUP + k)}" for k in keys],
        f"{spread_nulls(keys, keys)} as {_LOOKUP_SPREAD}",
    )
    match = [f"{quoted(k)} = {quoted(_LOOKUP + k)}" for k in keys] + [f"{_SPREAD} = {_LOOKUP_SPREAD}"]
    rows = update.selectExpr("*", f"{spread_nulls(keys, _hashable(update))} as {_SPREAD}")
    return rows.join(found, F.expr(" and ".join(match)), "left_anti").drop(_SPREAD)
