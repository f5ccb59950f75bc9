"""Change logs of the four entities, derived from the customer, nation, orders and events tables.

Key ``k`` gets the versions ``0 .. k % 3``. ``explode(sequence(...))`` makes them inside the scan stage,
so a log is as distributed as the table it comes from and adds no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import ENTITIES
from tidemark.sources.parquet import read_parquet
from tidemark.sources.registry import Sources


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


def _versions(rows: DataFrame, key: str) -> DataFrame:
    keyed = rows.selectExpr("*", f"{key} as k")
    return keyed.selectExpr("*", "explode(sequence(0, cast(k % 3 as int))) as ver")


def _log(rows: DataFrame, prefix: str, **business: str) -> DataFrame:
    change = {
        "_ab_cdc_lsn": "cast(1000 + k * 10 + ver as string)",
        "_ab_cdc_deleted_at": "case when k % 11 = 0 and ver = k % 3 then timestamp_ntz'2024-06-01 00:00:00' end",
        "_ab_cdc_updated_at": "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(ver)",
        "_airbyte_raw_id": f"concat('{prefix}-', k, '-', ver)",
        "_airbyte_extracted_at": "timestamp_ntz'2024-02-01 00:00:00' + make_dt_interval(ver)",
        "_airbyte_meta": "'{}'",
        "_airbyte_generation_id": "1L",
    }
    return rows.selectExpr(*[f"{value} as `{name}`" for name, value in (business | change).items()])


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customer = _versions(_table(spark, sf_dir, "customer"), "c_custkey")
    return _log(
        customer.join(nation, F.expr("c_nationkey = n_nationkey"), "left"),
        "u",
        user_id="cast(k as string)",
        email="concat(lower(c_name), '@example.com')",
        first_name="'Customer'",
        last_name="c_name",
        country="n_name",
        marital_status="case when k % 2 = 0 then 'single' else 'married' end",
        kyc_status="case when ver = 0 then 'pending' else 'verified' end",
        created_at="'2023-01-01 00:00:00'",
    )


def raw_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _log(
        _versions(_table(spark, sf_dir, "customer"), "c_custkey"),
        "a",
        account_id="cast(k as string)",
        user_id="cast(case when k % 97 = 0 then k + 1000000 else k end as string)",
        balance="cast(c_acctbal + ver as string)",
        currency="case when c_nationkey % 2 = 0 then 'USD' else 'EUR' end",
    )


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _log(
        _versions(_table(spark, sf_dir, "orders"), "o_orderkey"),
        "t",
        transaction_id="cast(k as string)",
        from_account="cast(o_custkey as string)",
        to_account="cast((o_custkey * 7 + 3) % 150 as string)",
        amount="case when k % 103 = 0 then null when k % 101 = 0 then '-1.5' else cast(o_totalprice as string) end",
        type="case when k % 2 = 0 then 'transfer' else 'payment' end",
        status="case when ver = 0 then 'pending' else 'completed' end",
        timestamp="cast(cast(o_orderdate as timestamp_ntz) as string)",
    )


def raw_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _log(
        _versions(_table(spark, sf_dir, "events"), "event_id"),
        "l",
        log_id="cast(k as string)",
        action="event_type",
        performed_by="concat('user_', user_id)",
        transaction_id="cast(event_id % 1500 as string)",
        timestamp="cast(cast(ts as timestamp_ntz) as string)",
    )


BUILDERS = {"users": raw_users, "accounts": raw_accounts, "transactions": raw_transactions, "audit": raw_audit}


def derived_sources(spark: SparkSession, sf_dir: str) -> Sources:
    """All four change logs under their entity names."""
    return Sources({name: BUILDERS[name](spark, sf_dir) for name in ENTITIES})
