"""Loads, staging, quarantine, the incremental fact and the command line."""

import datetime
import json

import pytest
from conftest import SF_DIR, explained, rows
from pyspark.sql import functions as F

from tidemark import jobs
from tidemark.functions import utc_date
from tidemark.operators.quarantine import release, split_malformed
from tidemark.operators.staging import stage, stamp_ingested_at, strip_metadata
from tidemark.plans import loads, marts
from tidemark.plans.queries import QUERIES
from tidemark.schemas import ACCOUNTS, CONTRACT, METADATA_COLUMNS, TRANSACTIONS
from tidemark.sources.derived import BUILDERS

CHANGE = (
    "'{lsn}' as _ab_cdc_lsn, {deleted} as _ab_cdc_deleted_at, timestamp'{clock}' as _ab_cdc_updated_at,"
    " '{key}-{lsn}' as _airbyte_raw_id, timestamp'{clock}' as _airbyte_extracted_at, '{{}}' as _airbyte_meta,"
    " 1L as _airbyte_generation_id"
)


def version(spark, key, lsn, clock, deleted=False, **business):
    change = CHANGE.format(
        key=key, lsn=lsn, clock=clock, deleted="timestamp'2024-01-09'" if deleted else "cast(null as timestamp)"
    )
    columns = [f"{'null' if v is None else repr(v)} as `{k}`" for k, v in business.items()]
    return spark.sql("select " + ", ".join(columns) + ", " + change)


def union(*frames):
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def account(spark, key, owner, lsn=1, clock="2024-01-01"):
    return version(spark, key, lsn, clock, account_id=str(key), user_id=str(owner), balance="1.5", currency="EUR")


def transaction(spark, key, lsn, clock, day, amount="1.0", sender="1", receiver="2", deleted=False):
    return version(
        spark, key, lsn, clock, deleted, transaction_id=str(key), from_account=sender, to_account=receiver,
        amount=amount, type="transfer", status="done", timestamp=f"{day} 10:00:00",
    )


def test_staging_types(spark):
    staged = stage(BUILDERS["transactions"](spark, SF_DIR), TRANSACTIONS)
    assert [(f.name, f.dataType.simpleString()) for f in staged.schema][:8] == [
        ("transaction_id", "bigint"), ("from_account_id", "bigint"), ("to_account_id", "bigint"),
        ("amount", "decimal(38,9)"), ("transaction_type", "string"), ("status", "string"),
        ("transaction_timestamp", "timestamp"), ("_ab_cdc_lsn", "decimal(38,9)"),
    ]


def test_bad_text_fails_staging_and_is_quarantined_otherwise(spark):
    raw = union(transaction(spark, 1, 1, "2024-01-01", "2024-01-01"), transaction(spark, 2, 1, "2024-01-01", "oops", "x"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        stage(raw, TRANSACTIONS).collect()
    good, bad = split_malformed(raw, TRANSACTIONS)
    assert rows(good.select("transaction_id")) == [(1,)]
    assert rows(bad.select("transaction_id", "quarantine_reason")) == [("2", "amount,timestamp")]


def test_corrected_rows_are_released_once(spark):
    raw = union(
        transaction(spark, 1, 1, "2024-01-01", "2024-01-01"),
        transaction(spark, 2, 1, "2024-01-01", "2024-01-01", "x"),
        transaction(spark, 3, 1, "2024-01-01", "oops", "y"),
        transaction(spark, 4, 1, "2024-01-01", "2024-01-01", "z").withColumn("_airbyte_raw_id", F.lit(None).cast("string")),
    )
    good, bad = split_malformed(raw, TRANSACTIONS)
    fixes = [("2-1", 1, "still x"), ("2-1", 2, "5.00"), ("3-1", 1, "6.00"), ("9-1", 1, "7.00"), (None, 1, "8.00")]
    corrections = spark.createDataFrame(fixes, "_airbyte_raw_id string, turn int, amount string")
    released, left = release(bad, corrections, good, TRANSACTIONS, "turn")
    assert rows(released.selectExpr("transaction_id", "cast(amount as double)")) == [(2, 5.0)]
    assert sorted(rows(left.select("transaction_id", "quarantine_reason"))) == [("3", "timestamp"), ("4", "amount")]
    again, still = release(bad, corrections, good.unionByName(released), TRANSACTIONS, "turn")
    assert again.isEmpty() and sorted(rows(still.select("transaction_id"))) == [("3",), ("4",)]


def test_strip_and_stamp(spark):
    raw = account(spark, 1, 1)
    stripped = strip_metadata(raw)
    assert stripped.columns == ["account_id", "user_id", "balance", "currency"]
    assert {"kyc_status", "created_at"}.isdisjoint(METADATA_COLUMNS)
    stamped = stamp_ingested_at(stripped, "2024-05-05 00:00:00")
    assert stamped.first().ingested_at == datetime.datetime(2024, 5, 5)
    assert stamp_ingested_at(stripped).first().ingested_at is not None


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Tokyo"])
def test_days_are_utc_days(spark, settings, zone):
    df = spark.sql(
        "select timestamp_seconds(s) as z, timestamp_ntz'2024-03-01 23:30:00' as n"
        " from values (1709335800L), (-1L), (0L) as t(s)"
    )
    settings(spark__sql__session__timeZone=zone)
    found = df.selectExpr(f"string({utc_date(df, 'z')})", f"string({utc_date(df, 'n')})")
    assert rows(found) == [("1969-12-31", "2024-03-01"), ("1970-01-01", "2024-03-01"), ("2024-03-01", "2024-03-01")]


def test_incremental_fact(spark, tmp_path):
    path = str(tmp_path / "fct")
    owners = stage(union(account(spark, 1, 100), account(spark, 2, 200)), ACCOUNTS)
    first = union(
        transaction(spark, 1, 1, "2024-01-01", "2024-01-01"),
        transaction(spark, 2, 1, "2024-01-02", "2024-01-01"),
    )

    def load(log, **options):
        return marts.load_fct_transactions(spark, stage(log, TRANSACTIONS), owners, path, **options)

    def found():
        df = marts.read_mart(spark, path).selectExpr(
            "transaction_id", "string(transaction_date)", "double(amount)", "from_user_id", "to_user_id"
        )
        return rows(df)

    assert load(first) is None
    assert found() == [(1, "2024-01-01", 1.0, 100, 200), (2, "2024-01-01", 1.0, 100, 200)]

    second = union(
        first,
        transaction(spark, 1, 2, "2024-01-03", "2024-01-02", "7.0"),  # changed, and on another day
        transaction(spark, 3, 1, "2024-01-01", "2024-01-01"),  # late: at or below both marks
        transaction(spark, 4, 1, "2024-01-04", "2024-01-01", receiver="9"),  # new, unknown receiver
        transaction(spark, 2, 2, "2024-01-05", "2024-01-01", deleted=True),  # a tombstone changes nothing
    )
    assert load(second).rows == 2
    expected = [
        (1, "2024-01-02", 7.0, 100, 200), (2, "2024-01-01", 1.0, 100, 200), (4, "2024-01-01", 1.0, 100, None),
    ]
    assert found() == expected
    assert load(second).rows == 0
    assert found() == expected
    assert load(second, full_refresh=True) is None
    assert [r[0] for r in found()] == [1, 2, 3, 4]


def test_an_existing_empty_target(spark, tmp_path):
    path = str(tmp_path / "fct")
    owners = stage(account(spark, 1, 100), ACCOUNTS)
    log = stage(transaction(spark, 1, 1, "2024-01-01", "2024-01-01"), TRANSACTIONS)
    facts = marts.fct_transactions(log, owners)
    facts.where("false").drop("transaction_date").write.parquet(f"{path}/transaction_date=2024-01-01")
    assert marts.load_fct_transactions(spark, log, owners, path).rows == 0
    assert marts.load_fct_transactions(spark, log, owners, path, empty_means_full=True) is None
    assert spark.read.parquet(path).count() == 1


def test_raw_load_counts_in_the_write(spark, tmp_path):
    union(account(spark, 1, 1), account(spark, 2, 2)).write.parquet(str(tmp_path / "in/d=1"))
    result = loads.raw_load(spark, str(tmp_path / "in"), "raw_accounts_table", "2024-05-05 00:00:00")
    assert (result.rows_read, result.rows_written) == (2, 2)
    assert spark.table("raw_accounts_table").columns == [
        "account_id", "user_id", "balance", "currency", "d", "ingested_at",
    ]


def test_evolving_load(spark, tmp_path):
    target = str(tmp_path / "live")
    spark.createDataFrame([(1, "x")], "a int, b string").write.parquet(str(tmp_path / "1"))
    spark.createDataFrame([(2.5, 3)], "c double, a bigint").write.parquet(str(tmp_path / "2"))
    first = loads.evolving_load(spark, str(tmp_path / "1"), target, "2024-05-05 00:00:00")
    assert first.discrepancies == [] and first.rows_written == 1
    second = loads.evolving_load(spark, str(tmp_path / "2"), target, "2024-05-06 00:00:00")
    assert len(second.discrepancies) == 3
    found = spark.read.parquet(target)
    assert found.columns == ["a", "b", "ingested_at", "c"]
    assert found.schema["a"].dataType.simpleString() == "bigint"
    assert rows(found.drop("ingested_at")) == [(3, None, 2.5)]


def test_an_unchanged_delivery_has_no_discrepancy(spark, tmp_path):
    target = str(tmp_path / "live")
    for name in ("1", "2"):
        spark.createDataFrame([(1, "x")], "a int, b string").write.parquet(str(tmp_path / name))
        assert loads.evolving_load(spark, str(tmp_path / name), target, "2024-05-05 00:00:00").discrepancies == []
    assert spark.read.parquet(target).columns == ["a", "b", "ingested_at"]


def test_evolving_load_takes_the_columns_of_all_files(spark, tmp_path):
    folder = tmp_path / "in"
    spark.createDataFrame([(1,)], "a int").write.parquet(str(folder))
    spark.createDataFrame([(2, "x")], "a int, b string").write.mode("append").parquet(str(folder))
    loads.evolving_load(spark, str(folder), str(tmp_path / "live"), "2024-05-05 00:00:00")
    assert rows(spark.read.parquet(str(tmp_path / "live")).select("a", "b")) == [(1, None), (2, "x")]


def test_contract_covers_the_staged_columns(spark):
    for name, required in CONTRACT.items():
        assert set(required) <= set(BUILDERS[name](spark, SF_DIR).columns)


def test_commands(spark, tmp_path, capsys):
    raw, out = tmp_path / "raw", str(tmp_path / "marts")

    def run(*argv):
        code = jobs.main(list(argv), spark)
        return code, json.loads(capsys.readouterr().out)

    assert run("contract", "--raw", str(raw))[0] == 1
    for name in ("users", "accounts", "audit"):
        BUILDERS[name](spark, SF_DIR).write.parquet(str(raw / name))
    union(
        transaction(spark, 1, 1, "2024-01-01", "2024-01-01", sender="5"), transaction(spark, 2, 1, "2024-01-01", "2024-01-02", "-3")
    ).selectExpr(
        "* except (_ab_cdc_deleted_at, _ab_cdc_updated_at, _airbyte_extracted_at)",
        *[f"cast({c} as timestamp_ntz) as {c}" for c in ("_ab_cdc_deleted_at", "_ab_cdc_updated_at", "_airbyte_extracted_at")],
    ).write.parquet(str(raw / "transactions"))
    assert run("contract", "--raw", str(raw)) == (0, {"missing": []})
    build = ("marts", "--raw", str(raw), "--out", out, "--timestamp-type", "timestamp_ntz")
    assert run(*build) == (0, {"fct_transactions": "full"})
    assert run(*build) == (0, {"fct_transactions": 0})
    code, report = run("check", "--marts", out, "--failures", str(tmp_path / "failures"))
    failures = {line["rule_name"]: line["failures"] for line in report}
    assert code == 1 and failures["accepted_range_fct_transactions_amount"] == 1
    assert spark.read.parquet(str(tmp_path / "failures/accepted_range_fct_transactions_amount")).count() == 1
    assert run("raw-load", "--input", str(raw / "users"), "--target", str(tmp_path / "loaded"))[1]["rows_read"] > 0
    assert run("evolving-load", "--input", str(raw / "users"), "--target", str(tmp_path / "live"))[0] == 0


@pytest.mark.parametrize("name", ["int_users", "int_transactions", "fct_transactions", "incremental_delta"])
def test_plans_stay_in_the_jvm(spark, name):
    plan = explained(QUERIES[name](spark, SF_DIR))
    for unwanted in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "ExistingRDD"):
        assert unwanted not in plan
    assert "WindowGroupLimit" in plan


def test_only_needed_columns_are_read(spark):
    plan = explained(QUERIES["fct_transactions"](spark, SF_DIR))
    schemas = [line for line in plan.splitlines() if line.startswith("ReadSchema")]
    assert all("o_orderpriority" not in line and "c_name" not in line and "c_acctbal" not in line for line in schemas)
    assert sum(line == "ReadSchema: struct<c_custkey:bigint>" for line in schemas) == 2


def test_a_quality_report_scans_the_stored_fact_once(spark):
    leaves = QUERIES["dq_report"](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().collectLeaves()
    scans = [leaves.apply(i).toString() for i in range(leaves.size())]
    assert sum("transaction_id" in scan for scan in scans) == 1
    plan = explained(QUERIES["dq_report"](spark, SF_DIR))
    assert "Python" not in plan and "Window" not in plan
