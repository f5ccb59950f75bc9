"""The registered queries: every operator over change logs derived from whole tables.

Decimals leave as doubles and timestamps stay zone-less, so that results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, TimestampType

from tidemark.functions import quoted
from tidemark.operators import quality
from tidemark.operators.joins import enrich_transactions, merge_upsert as merge_frames
from tidemark.operators.marks import Marks, high_water_mark as marks_of, touched_keys
from tidemark.operators.metrics import count_rows
from tidemark.operators.quarantine import REASON, release, split_malformed
from tidemark.operators.reconcile import reconcile as find_differences
from tidemark.operators.schema_history import judged_in_turn
from tidemark.operators.schema_ops import (
    contract_check as check_contract,
    drift_status as status_of,
    harmonize_schema as harmonize,
    resolve_collisions as separate,
    schema_drift as drift_of,
)
from tidemark.operators.staging import stage, stamp_ingested_at as stamp, strip_metadata as strip
from tidemark.operators.versions import current_rows, live_rows as live
from tidemark.plans import loads, marts
from tidemark.schemas import ACCOUNTS, AUDIT, RAW_ID, TRANSACTIONS, USERS, Entity
from tidemark.sinks.tables import overwrite_path, overwrite_self, store, write_partitioned
from tidemark.sinks.upsert import upsert_frame, upsert_partitions
from tidemark.sinks.versioned import VersionedTable, ledger_frame, read_published
from tidemark.sources.derived import BUILDERS, derived_sources
from tidemark.sources.parquet import read_generations, read_parquet
from tidemark.streaming import upsert_arrivals
from tidemark.workspace import new_run

AS_OF = "2024-07-01 00:00:00"
#: what the held-back first load has seen: extractions up to this time, and four keys in five
FIRST_LOAD_UNTIL = "2024-02-01 00:00:00"
HELD_BACK = 5


def _portable(df: DataFrame) -> DataFrame:
    decimals = {f.name for f in df.schema if isinstance(f.dataType, DecimalType)}
    return df.selectExpr(*[f"cast({quoted(c)} as double) as {quoted(c)}" if c in decimals else quoted(c) for c in df.columns])


def _ntz(value: str):
    return F.lit(value).cast("timestamp_ntz")


def _raw(spark: SparkSession, sf_dir: str, entity: Entity) -> DataFrame:
    return BUILDERS[entity.name](spark, sf_dir)


def _staged(spark: SparkSession, sf_dir: str, entity: Entity) -> DataFrame:
    return stage(_raw(spark, sf_dir, entity), entity, "timestamp_ntz")


def _first_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current transactions as an earlier run saw them."""
    seen = _staged(spark, sf_dir, TRANSACTIONS).where(
        (F.col("_airbyte_extracted_at") <= _ntz(FIRST_LOAD_UNTIL)) & (F.col("transaction_id") % HELD_BACK != 0)
    )
    return current_rows(seen, TRANSACTIONS)


def _marts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    accounts = _staged(spark, sf_dir, ACCOUNTS)
    return {
        "dim_users": marts.dim_users(_staged(spark, sf_dir, USERS)),
        "dim_accounts": marts.dim_accounts(accounts),
        "fct_transactions": marts.fct_transactions(_staged(spark, sf_dir, TRANSACTIONS), accounts),
    }


# --- scans and sources -------------------------------------------------------------------------------


def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lands the transaction log as a folder of files, scans it and counts its rows by type and status."""
    path = overwrite_path(_raw(spark, sf_dir, TRANSACTIONS), new_run(spark, "scan"))
    return read_parquet(spark, path).groupBy("type", "status").agg(F.count(F.lit(1)).alias("row_count"))


def scan_merge_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First versions of the users land without two columns that later versions have."""
    path = new_run(spark, "scan_merge")
    users = _raw(spark, sf_dir, USERS)
    first = F.col("_airbyte_extracted_at") == _ntz(FIRST_LOAD_UNTIL)
    overwrite_path(users.where(first).drop("kyc_status", "marital_status"), f"{path}/delivery=1")
    overwrite_path(users.where(~first), f"{path}/delivery=2")
    merged = read_parquet(spark, path, merge_schema=True)
    return strip(merged).drop("delivery").select(*[c.raw for c in USERS.business])


def scan_generations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries whose types conflict: int against bigint, number against text, a missing column."""
    path = new_run(spark, "scan_generations")
    accounts = _raw(spark, sf_dir, ACCOUNTS).select("account_id", "user_id", "balance", "currency", "_airbyte_raw_id")
    first = F.col("_airbyte_raw_id").endswith("-0")
    old = accounts.where(first).select(
        F.col("account_id").cast("int"), F.col("user_id").cast("int"), F.col("balance").cast("decimal(12,2)"), "_airbyte_raw_id"
    )
    new = accounts.where(~first).select(
        F.col("account_id").cast("bigint"), "user_id", F.col("balance").cast("decimal(20,4)"), "currency", "_airbyte_raw_id"
    )
    found = read_generations(
        spark, [overwrite_path(old, f"{path}/delivery=1"), overwrite_path(new, f"{path}/delivery=2")]
    )
    return found.withColumn("balance", F.col("balance").cast("string"))


def source_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The named sources used from SQL text: log rows and distinct keys per source."""
    sources = derived_sources(spark, sf_dir)
    sources.views("raw_")
    parts = [
        f"select '{e.name}' as source_name, count(*) as log_rows, count(distinct {e.key}) as key_count from raw_{e.name}"
        for e in (USERS, ACCOUNTS, TRANSACTIONS, AUDIT)
    ]
    return spark.sql(" union all ".join(parts))


# --- projections and filters -------------------------------------------------------------------------


def strip_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strip(_raw(spark, sf_dir, USERS))


def stamp_ingested_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stamp(strip(_raw(spark, sf_dir, ACCOUNTS)), _ntz(AS_OF))


def stg_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _portable(_staged(spark, sf_dir, USERS))


def stg_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _portable(_staged(spark, sf_dir, ACCOUNTS))


def stg_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _portable(_staged(spark, sf_dir, TRANSACTIONS))


def stg_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _portable(_staged(spark, sf_dir, AUDIT))


def stg_transactions_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The types of production: zoned clocks, zone-less only at the end, and decimals with all their digits, as text."""
    staged = stage(_raw(spark, sf_dir, TRANSACTIONS), TRANSACTIONS, "timestamp")
    edge = {TimestampType: "timestamp_ntz", DecimalType: "string"}
    return staged.selectExpr(
        *[
            f"cast({quoted(f.name)} as {edge[type(f.dataType)]}) as {quoted(f.name)}" if type(f.dataType) in edge else quoted(f.name)
            for f in staged.schema
        ]
    )


def live_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _portable(live(_staged(spark, sf_dir, TRANSACTIONS)))


# --- versions ----------------------------------------------------------------------------------------


def int_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _portable(current_rows(_staged(spark, sf_dir, USERS), USERS))


def int_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _portable(current_rows(_staged(spark, sf_dir, ACCOUNTS), ACCOUNTS))


def int_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _portable(current_rows(_staged(spark, sf_dir, TRANSACTIONS), TRANSACTIONS))


def int_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _portable(current_rows(_staged(spark, sf_dir, AUDIT), AUDIT))


def int_users_rank_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _portable(current_rows(_staged(spark, sf_dir, USERS), USERS, tombstones="rank_first"))


def int_transactions_rank_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _portable(current_rows(_staged(spark, sf_dir, TRANSACTIONS), TRANSACTIONS, tombstones="rank_first"))


# --- joins -------------------------------------------------------------------------------------------


def int_transactions_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = current_rows(_staged(spark, sf_dir, TRANSACTIONS), TRANSACTIONS)
    return _portable(enrich_transactions(current, marts.dim_accounts(_staged(spark, sf_dir, ACCOUNTS))))


def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First versions of the users, but for a country added later, updated with the later versions.

    Every third update has no country.
    """
    users = _staged(spark, sf_dir, USERS)
    first = F.col("_airbyte_extracted_at") == _ntz(FIRST_LOAD_UNTIL)
    main = current_rows(users.where(first & (F.col("country") != "NATION_1")), USERS)
    update = current_rows(users.where(~first), USERS).withColumn(
        "country", F.when(F.col("user_id") % 3 != 0, F.col("country"))
    )
    run = new_run(spark, "merge")
    # Both are read more than once.
    stored = [store(df, f"{run}/{name}") for name, df in (("main", main), ("update", update))]
    return _portable(merge_frames(*stored, ["user_id"]))


def resolve_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users and accounts joined on the owner, their like-named clocks kept apart."""
    users = marts.dim_users(_staged(spark, sf_dir, USERS))
    accounts = marts.dim_accounts(_staged(spark, sf_dir, ACCOUNTS))
    left, right = separate(users, accounts, ["user_id"], "user_", "account_")
    return _portable(left.join(right, "user_id", "full"))


# --- increments --------------------------------------------------------------------------------------


def high_water_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marks_of(_first_current(spark, sf_dir))


def incremental_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changed facts by ranking only the keys with a row past a mark."""
    # The owner lookups of the fact leave its clocks as they are, so the marks need no joins.
    marks = Marks.fetched(_first_current(spark, sf_dir))
    transactions = _staged(spark, sf_dir, TRANSACTIONS)
    touched = store(touched_keys(transactions, TRANSACTIONS, marks), new_run(spark, "touched"))
    return _portable(
        marts.fct_transactions_increment(transactions, _staged(spark, sf_dir, ACCOUNTS), marks, touched)
    )


def incremental_delta_full_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changed facts by ranking the whole log, the marks as subqueries."""
    marks = Marks.deferred(_first_current(spark, sf_dir))
    return _portable(
        marts.fct_transactions_increment(
            _staged(spark, sf_dir, TRANSACTIONS), _staged(spark, sf_dir, ACCOUNTS), marks
        )
    )


def incremental_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact after a second run: a stored first load with the stored increment in place of its keys."""
    path = new_run(spark, "fct_transactions")
    transactions, accounts = _staged(spark, sf_dir, TRANSACTIONS), _staged(spark, sf_dir, ACCOUNTS)
    first = store(
        marts.transaction_facts(_first_current(spark, sf_dir), marts.dim_accounts(accounts)), f"{path}/target"
    )
    marks = Marks.fetched(first)
    touched = store(touched_keys(transactions, TRANSACTIONS, marks), f"{path}/touched")
    delta = store(marts.fct_transactions_increment(transactions, accounts, marks, touched), f"{path}/delta")
    return _portable(upsert_frame(first, delta, TRANSACTIONS.key))


def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions that the marks left behind: the log's current rows against the fact after an increment."""
    run = new_run(spark, "reconcile")
    transactions, accounts = _staged(spark, sf_dir, TRANSACTIONS), _staged(spark, sf_dir, ACCOUNTS)
    seen = (F.col("_airbyte_extracted_at") <= _ntz(FIRST_LOAD_UNTIL)) & (F.col("transaction_id") % HELD_BACK != 0)
    for log in (transactions.where(seen), transactions):
        marts.load_fct_transactions(spark, log, accounts, f"{run}/fct")
    columns = ("amount", "status", "transaction_timestamp", "last_updated_at", "ingested_at")
    return find_differences(current_rows(transactions, TRANSACTIONS), read_published(spark, f"{run}/fct"), TRANSACTIONS.key, columns, f"{run}/digests")


def load_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What three loads of the audit fact did, the second of them made twice under one name."""
    path = new_run(spark, "ledger")
    staged = _staged(spark, sf_dir, AUDIT)
    seen = (F.col("_airbyte_extracted_at") <= _ntz(FIRST_LOAD_UNTIL)) & (F.col("log_id") % HELD_BACK != 0)
    for name, log in (("first", staged.where(seen)), ("second", staged), ("second", staged), ("third", staged)):
        marts.load_incremental(spark, path, log, AUDIT, marts.audit_facts, marts.AUDIT_DAY, marts.AUDIT_CLUSTER, load=name)
    return ledger_frame(spark, path).select("load_number", "load", "kind", "rows_in", "rows")


def schema_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five deliveries of the accounts: first seen, a wider owner and a new column, the old shape again, a lost column, text for a number."""
    accounts = _raw(spark, sf_dir, ACCOUNTS).selectExpr("cast(account_id as bigint) as account_id", "cast(user_id as int) as user_id", "currency", "_airbyte_raw_id as raw_id")
    first = accounts.where("raw_id like '%-0'").drop("raw_id")
    later = accounts.where("raw_id not like '%-0'").drop("raw_id")
    wider = later.selectExpr("account_id", "cast(user_id as bigint) as user_id", "currency", "case when account_id % 2 = 0 then 'even' end as segment")
    deliveries = [first, wider, wider.withColumn("user_id", F.col("user_id").cast("int")), wider.drop("currency"), wider.withColumn("account_id", F.col("account_id").cast("string"))]
    return judged_in_turn(spark, new_run(spark, "schema-history"), deliveries)


def _first_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit fact as an earlier run left it, one event in four still filed under the next day."""
    seen = _staged(spark, sf_dir, AUDIT).where(
        (F.col("_airbyte_extracted_at") <= _ntz(FIRST_LOAD_UNTIL)) & (F.col("log_id") % HELD_BACK != 0)
    )
    late = F.col("log_id") % 4 == 0
    return marts.fct_audit(seen).withColumn(
        "event_date", F.when(late, F.date_add("event_date", 1)).otherwise(F.col("event_date"))
    )


def partitioned_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored form of the upsert, on the audit fact, as rows change day; a third run finds nothing."""
    first = _first_audit(spark, sf_dir)
    path = new_run(spark, "fct_audit")
    VersionedTable(spark, path, AUDIT.key, marts.AUDIT_DAY, marts.AUDIT_CLUSTER, marts.CLOCKS).replace(first)
    staged = _staged(spark, sf_dir, AUDIT)
    for _ in range(2):
        marts.load_incremental(
            spark,
            path,
            staged,
            AUDIT,
            marts.audit_facts,
            marts.AUDIT_DAY,
            marts.AUDIT_CLUSTER,
        )
    return read_published(spark, path)


def upsert_emptied_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An upsert that moves every row of the odd days on by a day, so that these are left empty."""
    facts = marts.fct_audit(_staged(spark, sf_dir, AUDIT))
    path = write_partitioned(facts, new_run(spark, "moved"), marts.AUDIT_DAY, marts.AUDIT_CLUSTER)
    moved = facts.where(F.dayofmonth("event_date") % 2 == 1).withColumn("event_date", F.date_add("event_date", 1))
    upsert_partitions(spark, path, moved, AUDIT.key, marts.AUDIT_DAY, marts.AUDIT_CLUSTER)
    return read_parquet(spark, path, schema=facts.schema)


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit log lands in two waves, the later versions first; each is taken in by the stream."""
    path = new_run(spark, "stream")
    log = _raw(spark, sf_dir, AUDIT)
    first = F.col("_airbyte_extracted_at") == _ntz(FIRST_LOAD_UNTIL)
    for wave in (log.where(~first), log.where(first)):
        wave.write.mode("append").parquet(f"{path}/landing")
        upsert_arrivals(
            spark,
            f"{path}/landing",
            log.schema,
            AUDIT,
            marts.audit_facts,
            f"{path}/fct_audit",
            marts.AUDIT_DAY,
            f"{path}/progress",
            marts.AUDIT_CLUSTER,
            "timestamp_ntz",
        )
    return read_published(spark, f"{path}/fct_audit")


# --- marts -------------------------------------------------------------------------------------------


def dim_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The users dimension, written and read back."""
    path = marts.load_dimension(marts.dim_users(_staged(spark, sf_dir, USERS)), new_run(spark, "dim_users"))
    return _portable(read_published(spark, path))


def dim_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The accounts dimension, written and read back."""
    path = marts.load_dimension(marts.dim_accounts(_staged(spark, sf_dir, ACCOUNTS)), new_run(spark, "dim_accounts"))
    return _portable(read_published(spark, path))


def fct_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _portable(
        marts.fct_transactions(_staged(spark, sf_dir, TRANSACTIONS), _staged(spark, sf_dir, ACCOUNTS))
    )


def fct_transactions_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored fact after a first load of what an earlier run saw, an increment, and a run that finds nothing."""
    path = new_run(spark, "fct_transactions_load")
    transactions, accounts = _staged(spark, sf_dir, TRANSACTIONS), _staged(spark, sf_dir, ACCOUNTS)
    seen = (F.col("_airbyte_extracted_at") <= _ntz(FIRST_LOAD_UNTIL)) & (F.col("transaction_id") % HELD_BACK != 0)
    marts.load_fct_transactions(spark, transactions.where(seen), accounts, path)
    for _ in range(2):
        marts.load_fct_transactions(spark, transactions, accounts, path)
    return _portable(read_published(spark, path))


def fct_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit fact, written by day and read back."""
    staged = _staged(spark, sf_dir, AUDIT)
    path = marts.load_fct_audit(staged, new_run(spark, "fct_audit"))
    return _portable(read_published(spark, path))


# --- sinks and loads ---------------------------------------------------------------------------------


def sink_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts are written, then overwritten by a frame that reads them."""
    path = new_run(spark, "dim_accounts")
    stored = store(marts.dim_accounts(_staged(spark, sf_dir, ACCOUNTS)), path)
    overwrite_self(stored.withColumn("balance", F.col("balance") + 1), path)
    return _portable(read_parquet(spark, path))


def partitioned_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit fact written by day and read back by day and action."""
    audit = marts.fct_audit(_staged(spark, sf_dir, AUDIT))
    path = write_partitioned(audit, new_run(spark, "fct_audit"), marts.AUDIT_DAY, marts.AUDIT_CLUSTER)
    stored = read_parquet(spark, path, schema=audit.schema)
    return stored.groupBy("event_date", "action").agg(
        F.count(F.lit(1)).alias("row_count"), F.max("event_timestamp").alias("last_event")
    )


def row_count_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows into and out of the version step of each table, counted while the result is written."""
    path = new_run(spark, "metrics")
    counts = []
    for entity in (USERS, ACCOUNTS, TRANSACTIONS, AUDIT):
        log, read = count_rows(_staged(spark, sf_dir, entity), "read")
        current, kept = count_rows(current_rows(log, entity), "kept")
        overwrite_path(current, f"{path}/{entity.name}")
        counts.append((entity.name, read.get["rows"], kept.get["rows"]))
    return spark.createDataFrame(counts, "table_name string, rows_read bigint, rows_kept bigint")


def raw_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lands the user log in two deliveries of different shape and loads them as one table."""
    path = new_run(spark, "raw_load")
    users = _raw(spark, sf_dir, USERS)
    first = F.col("_airbyte_extracted_at") == _ntz(FIRST_LOAD_UNTIL)
    overwrite_path(users.where(first).drop("country"), f"{path}/in/delivery=1")
    overwrite_path(users.where(~first), f"{path}/in/delivery=2")
    loads.raw_load(spark, f"{path}/in", f"{path}/users", _ntz(AS_OF))
    return read_parquet(spark, f"{path}/users").drop("delivery")


def raw_load_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries in one folder, the owner an int in one and a bigint in the other, loaded as one table."""
    path = new_run(spark, "raw_load_conflict")
    accounts = _raw(spark, sf_dir, ACCOUNTS)
    first = F.col("_airbyte_extracted_at") == _ntz(FIRST_LOAD_UNTIL)
    overwrite_path(accounts.where(first).withColumn("user_id", F.col("user_id").cast("int")), f"{path}/in/delivery=1")
    overwrite_path(accounts.where(~first).withColumn("user_id", F.col("user_id").cast("bigint")), f"{path}/in/delivery=2")
    loads.raw_load(spark, f"{path}/in", f"{path}/accounts", _ntz(AS_OF))
    return read_parquet(spark, f"{path}/accounts")


def evolving_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delivery that lost a column and gained one replaces the live table in the table's shape."""
    path = new_run(spark, "evolving_load")
    users = strip(_raw(spark, sf_dir, USERS))
    target = f"{path}/users"
    overwrite_path(users, f"{path}/first")
    loads.evolving_load(spark, f"{path}/first", target, _ntz("2024-06-01 00:00:00"))
    overwrite_path(
        users.drop("marital_status").withColumn("segment", F.upper("country")),
        f"{path}/second",
    )
    loads.evolving_load(spark, f"{path}/second", target, _ntz(AS_OF))
    return read_parquet(spark, target)


# --- schema work -------------------------------------------------------------------------------------


def harmonize_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    production = current_rows(_staged(spark, sf_dir, USERS), USERS)
    incoming = strip(_raw(spark, sf_dir, USERS)).drop("country").withColumn("segment", F.upper("last_name"))
    return _portable(harmonize(incoming, production))


def _drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text transactions, some with unreadable amounts, against the typed current table."""
    incoming = _malformed_transactions(spark, sf_dir).drop("status").withColumnsRenamed(
        {"from_account": "from_account_id", "timestamp": "transaction_timestamp"}
    )
    return drift_of(incoming, current_rows(_staged(spark, sf_dir, TRANSACTIONS), TRANSACTIONS))


def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drift(spark, sf_dir)


def schema_drift_truncation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts whose digits and times of day the target's types would cut."""
    accounts = marts.dim_accounts(_staged(spark, sf_dir, ACCOUNTS))
    cut = F.when(F.col("account_id") % 3 == 0, F.lit("0.0000000001").cast("decimal(38,12)"))
    incoming = accounts.select(
        (F.col("account_id") + F.when(F.col("account_id") % 5 == 0, 0.5).otherwise(0.0)).alias("account_id"),
        (F.col("balance").cast("decimal(37,12)") + F.coalesce(cut, F.lit(0))).cast("decimal(38,12)").alias("balance"),
        (F.col("last_updated_at") + F.expr("make_dt_interval(0, cast(account_id % 2 as int))")).alias("last_updated_at"),
        F.when(F.col("user_id") % 7 == 0, F.concat(F.col("user_id").cast("string"), F.lit(".50"))).otherwise(F.concat(F.col("user_id").cast("string"), F.lit(".0"))).alias("user_id"),
    )
    target = accounts.select(
        "account_id", "balance", F.col("last_updated_at").cast("date").alias("last_updated_at"), F.col("user_id").cast("decimal(20,0)")
    )
    return drift_of(incoming, target)


def drift_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status_of(_drift(spark, sf_dir))


def contract_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delivery without the audit log and without two columns of the accounts."""
    frames = dict(derived_sources(spark, sf_dir))
    frames["accounts"] = frames["accounts"].drop("currency", "_ab_cdc_lsn")
    del frames["audit"]
    return check_contract(frames)


# --- quality -----------------------------------------------------------------------------------------


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated keys in the live logs, and in the facts made from them (none)."""
    log = quality.duplicate_keys(live(_staged(spark, sf_dir, TRANSACTIONS)), "transaction_id")
    facts = quality.duplicate_keys(_marts(spark, sf_dir)["fct_transactions"], "transaction_id")
    return log.withColumn("table_name", F.lit("log")).unionByName(facts.withColumn("table_name", F.lit("fact")))


def _stored_marts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The marts written once, so that no rule builds them again."""
    run = new_run(spark, "marts")
    accounts = store(marts.dim_accounts(_staged(spark, sf_dir, ACCOUNTS)), f"{run}/dim_accounts")
    current = current_rows(_staged(spark, sf_dir, TRANSACTIONS), TRANSACTIONS)
    return {
        "dim_users": store(marts.dim_users(_staged(spark, sf_dir, USERS)), f"{run}/dim_users"),
        "dim_accounts": accounts,
        "fct_transactions": store(marts.transaction_facts(current, accounts), f"{run}/fct_transactions"),
    }


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [rule for rule in quality.MART_RULES if rule.kind == quality.NOT_NULL]
    return quality.quality_report(_stored_marts(spark, sf_dir), rules)


def dq_accepted_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    (rule,) = [rule for rule in quality.MART_RULES if rule.kind == quality.ACCEPTED_RANGE]
    return _portable(quality.failing_rows(_marts(spark, sf_dir), rule))


def dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    (rule,) = [rule for rule in quality.MART_RULES if rule.kind == quality.RELATIONSHIPS]
    return quality.failing_rows(_marts(spark, sf_dir), rule)


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(_stored_marts(spark, sf_dir))


def dq_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failing rows of all rules, stored and read back: the rule and the value of its column, as text."""
    folder = quality.store_tagged_failures(_stored_marts(spark, sf_dir), folder=new_run(spark, "test_failures"))
    value = F.col("value").cast("double").cast("decimal(18,4)").cast("string").alias("value")
    return read_parquet(spark, folder, schema="value string, n_records bigint, record string, rule_name string").select("rule_name", value)


def _malformed_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("transaction_id").cast("bigint")
    return _raw(spark, sf_dir, TRANSACTIONS).withColumns(
        {
            "amount": F.when(key % 211 == 0, "n/a").otherwise(F.col("amount")),
            "to_account": F.when(key % 223 == 0, "unknown").otherwise(F.col("to_account")),
        }
    )


def quarantine_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, bad = split_malformed(_malformed_transactions(spark, sf_dir), TRANSACTIONS, "timestamp_ntz")
    counted = good.groupBy("transaction_type").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("to_account_id").alias("account_sum")
    )
    return counted.select(
        F.lit("good").alias("verdict"), F.col("transaction_type").alias("item"), "row_count", "account_sum"
    ).unionByName(
        bad.groupBy("quarantine_reason")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(
            F.lit("bad").alias("verdict"),
            F.col("quarantine_reason").alias("item"),
            "row_count",
            F.lit(None).cast("bigint").alias("account_sum"),
        )
    )


def quarantine_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Malformed transactions corrected by raw id and replayed twice: amounts are mended, and accounts of even ids."""
    run = new_run(spark, "quarantine_release")
    good, bad = split_malformed(_malformed_transactions(spark, sf_dir), TRANSACTIONS, "timestamp_ntz")
    bad = store(bad, f"{run}/bad")
    even = F.col("transaction_id").cast("bigint") % 2 == 0
    fixes = bad.select(
        RAW_ID,
        F.lit(1).alias("turn"),
        F.when(F.col("amount") == "n/a", "12.50").alias("amount"),
        F.when((F.col("to_account") == "unknown") & even, "7").alias("to_account"),
    )
    stale = fixes.withColumns({"turn": F.lit(0), "amount": F.lit("still n/a"), "to_account": F.lit("still unknown")})
    corrections = fixes.unionByName(stale)
    first, left = (store(df, f"{run}/{name}") for df, name in zip(release(bad, corrections, good, TRANSACTIONS, "turn", "timestamp_ntz"), ("first", "left"), strict=True))
    again, _ = release(bad, corrections, good.select(RAW_ID).union(first.select(RAW_ID)), TRANSACTIONS, "turn", "timestamp_ntz")
    none = F.lit(None).cast("bigint").alias("account_sum")
    counted = first.groupBy("transaction_type").agg(F.count(F.lit(1)).alias("row_count"), F.sum("to_account_id").alias("account_sum"))
    return (
        counted.select(F.lit("released").alias("verdict"), F.col("transaction_type").alias("item"), "row_count", "account_sum")
        .unionByName(left.groupBy(F.col(REASON).alias("item")).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit("left").alias("verdict"), "item", "row_count", none))
        .unionByName(again.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit("again").alias("verdict"), F.lit("all").alias("item"), "row_count", none))
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        scan_parquet,
        scan_merge_schema,
        scan_generations,
        source_views,
        strip_metadata,
        stamp_ingested_at,
        stg_users,
        stg_accounts,
        stg_transactions,
        stg_audit,
        stg_transactions_exact,
        live_rows,
        int_users,
        int_accounts,
        int_transactions,
        int_audit,
        int_users_rank_first,
        int_transactions_rank_first,
        int_transactions_enriched,
        merge_upsert,
        resolve_collisions,
        high_water_mark,
        incremental_delta,
        incremental_delta_full_rank,
        incremental_upsert,
        reconcile,
        load_ledger,
        partitioned_upsert,
        upsert_emptied_days,
        stream_upsert,
        dim_users,
        dim_accounts,
        fct_transactions,
        fct_transactions_load,
        fct_audit,
        sink_overwrite,
        partitioned_write,
        row_count_metrics,
        raw_load,
        raw_load_conflict,
        evolving_load,
        harmonize_schema,
        schema_drift,
        schema_drift_truncation,
        drift_status,
        schema_history,
        contract_check,
        dq_unique,
        dq_not_null,
        dq_accepted_range,
        dq_relationships,
        dq_report,
        dq_failures,
        quarantine_split,
        quarantine_release,
    )
}
