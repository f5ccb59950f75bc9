"""Dimensions and facts as functions from staged logs to frames, and their loads."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions import utc_date
from tidemark.operators.joins import enrich_transactions
from tidemark.operators.marks import INGESTED_CLOCK, UPDATED_CLOCK, Marks, incremental_rows, touched_keys
from tidemark.operators.versions import current_rows
from tidemark.schemas import ACCOUNTS, AUDIT, FCT_AUDIT_COLUMNS, FCT_TRANSACTIONS_COLUMNS, TRANSACTIONS, USERS, Entity
from tidemark.sinks import journal
from tidemark.sinks.tables import store, write_target
from tidemark.sinks.upsert import UpsertResult, recover, upsert_partitions, write_in_full
from tidemark.sinks.versioned import Published, VersionedTable, clock_value, is_published, read_published
from tidemark.sources.parquet import probe_path, read_parquet
from tidemark.workspace import new_run, remove_run

# Layout of the two facts.
TRANSACTION_DAY = "transaction_date"
TRANSACTION_CLUSTER = ("transaction_type", "status")
AUDIT_DAY = "event_date"
AUDIT_CLUSTER = ("action",)
CLOCKS = (UPDATED_CLOCK, INGESTED_CLOCK)


def dim_users(staged_users: DataFrame) -> DataFrame:
    return current_rows(staged_users, USERS)


def dim_accounts(staged_accounts: DataFrame) -> DataFrame:
    return current_rows(staged_accounts, ACCOUNTS)


def fct_audit(staged_audit: DataFrame) -> DataFrame:
    return audit_facts(current_rows(staged_audit, AUDIT))


def audit_facts(current: DataFrame) -> DataFrame:
    day = f"{utc_date(current, 'event_timestamp')} as {AUDIT_DAY}"
    return current.selectExpr("*", day).selectExpr(*FCT_AUDIT_COLUMNS)


def fct_transactions(staged_transactions: DataFrame, staged_accounts: DataFrame) -> DataFrame:
    """All current transactions with their owners and day."""
    return transaction_facts(current_rows(staged_transactions, TRANSACTIONS), dim_accounts(staged_accounts))


def transaction_facts(current: DataFrame, accounts: DataFrame) -> DataFrame:
    enriched = enrich_transactions(current, accounts)
    day = f"{utc_date(enriched, 'transaction_timestamp')} as {TRANSACTION_DAY}"
    return enriched.selectExpr("*", day).selectExpr(*FCT_TRANSACTIONS_COLUMNS)


def fct_transactions_increment(
    staged_transactions: DataFrame,
    staged_accounts: DataFrame,
    marks: Marks,
    touched: DataFrame | None = None,
) -> DataFrame:
    """Facts changed since the ``marks`` of the loaded table.

    The marks are applied before the owner lookups, so only changed rows are joined.
    """
    changed = incremental_rows(staged_transactions, TRANSACTIONS, marks, touched)
    return transaction_facts(changed, dim_accounts(staged_accounts))


def load_dimension(df: DataFrame, target: str, fmt: str = "parquet") -> str:
    """Full refresh. A parquet folder is versioned: it is written aside and readers change over in one step."""
    if "/" in target and fmt == "parquet" and not _is_plain(df.sparkSession, target):
        VersionedTable(df.sparkSession, target).replace(df)
        return target
    return write_target(df, target, fmt)


def load_fct_audit(staged_audit: DataFrame, path: str) -> str:
    """Full refresh, laid out by day."""
    spark = staged_audit.sparkSession
    if _is_plain(spark, path):
        return write_in_full(fct_audit(staged_audit), path, AUDIT_DAY, AUDIT_CLUSTER)
    VersionedTable(spark, path, AUDIT.key, AUDIT_DAY, AUDIT_CLUSTER, CLOCKS).replace(fct_audit(staged_audit))
    return path


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    """A stored mart: the current version, or the folder as it is if it was not published by versions."""
    return read_published(spark, path) if is_published(spark, path) else read_parquet(spark, path)


def _is_plain(spark: SparkSession, path: str) -> bool:
    """A folder that holds files, or the record of a publish, but no manifest."""
    if is_published(spark, path):
        return False
    return journal.pending(spark, path) is not None or probe_path(spark, path) is not None


def load_fct_transactions(
    spark: SparkSession,
    staged_transactions: DataFrame,
    staged_accounts: DataFrame,
    path: str,
    full_refresh: bool = False,
    empty_means_full: bool = False,
) -> Published | UpsertResult | None:
    """First run or full refresh: everything. Later runs: upsert of the increment."""
    return load_incremental(
        spark,
        path,
        staged_transactions,
        TRANSACTIONS,
        lambda current: transaction_facts(current, dim_accounts(staged_accounts)),
        TRANSACTION_DAY,
        TRANSACTION_CLUSTER,
        full_refresh,
        empty_means_full,
    )


def load_incremental(
    spark: SparkSession,
    path: str,
    staged: DataFrame,
    entity: Entity,
    facts: Callable[[DataFrame], DataFrame],
    partition_by: str,
    cluster_by: Sequence[str] = (),
    full_refresh: bool = False,
    empty_means_full: bool = False,
    load: str | None = None,
) -> Published | UpsertResult | None:
    """Load a keyed, day-partitioned fact; returns ``None`` after a full write.

    The target is a versioned table: its manifest has the marks and says which files may hold a changed key, so
    the target is not scanned for either, and a load that dies leaves the version before it. ``load`` names the
    load; one that is repeated under its name changes nothing. A folder of days that was written without a
    manifest goes on as one, see ``_load_plain``.

    ``facts`` turns current rows into rows of the fact. An existing but empty target has no marks, so
    nothing passes them; ``empty_means_full`` loads everything in that case. The marks are fetched as
    plain values, by which the scan of the log can skip row groups.
    """
    everything = facts(current_rows(staged, entity))
    if _is_plain(spark, path):
        return _load_plain(spark, path, staged, entity, facts, everything, partition_by, cluster_by, full_refresh, empty_means_full)
    table = VersionedTable(spark, path, entity.key, partition_by, cluster_by, CLOCKS)
    head = table.head()
    if full_refresh or head is None or (empty_means_full and not head.rows):
        table.replace(everything, load)
        return None
    marks = Marks(*(clock_value(head, c) for c in CLOCKS))
    run = new_run(spark, "touched")
    touched = store(touched_keys(staged, entity, marks), run)
    result = table.upsert(facts(incremental_rows(staged, entity, marks, touched)), load)
    remove_run(spark, run)
    return result


def _load_plain(
    spark: SparkSession,
    path: str,
    staged: DataFrame,
    entity: Entity,
    facts: Callable[[DataFrame], DataFrame],
    everything: DataFrame,
    partition_by: str,
    cluster_by: Sequence[str],
    full_refresh: bool,
    empty_means_full: bool,
) -> UpsertResult | None:
    """The same for a folder of days without a manifest.

    A publish that an earlier run left half done is finished before the marks are taken, and a full write
    that was cut off is made again, so that no row stays below marks it never reached.
    """
    if not full_refresh and recover(spark, path) and probe_path(spark, path) is not None:
        target = read_parquet(spark, path, schema=everything.schema)
        if not (empty_means_full and target.isEmpty()):
            marks = Marks.fetched(target)
            run = new_run(spark, "touched")
            touched = store(touched_keys(staged, entity, marks), run)
            delta = facts(incremental_rows(staged, entity, marks, touched))
            result = upsert_partitions(spark, path, delta, entity.key, partition_by, cluster_by)
            remove_run(spark, run)
            return result
    write_in_full(everything, path, partition_by, cluster_by)
    return None
