"""Reconciliation, accepted schemas, failures in one pass, and the optional subpackage."""

import subprocess
import sys
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark import workspace
from tidemark.operators import quality
from tidemark.operators.reconcile import differing_buckets, reconcile, store_digests
from tidemark.operators.schema_history import BreakingSchema, SchemaHistory, type_change


def test_reconcile_finds_missing_stale_and_extra_keys(spark, tmp_path):
    expected = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (None, "n"), (6, "f")], "k bigint, v string")
    actual = spark.createDataFrame([(1, "a"), (2, "x"), (3, None), (4, "d"), (None, "m")], "k bigint, v string")
    found = reconcile(expected, actual, "k", ["v"], str(tmp_path / "d"))
    assert rows(found) == [(None, "stale"), (2, "stale"), (4, "extra"), (6, "missing")]
    assert reconcile(expected, expected, "k", ["v"], str(tmp_path / "e")).collect() == []
    assert len(reconcile(expected, expected.where("false"), "k", ["v"], str(tmp_path / "f")).collect()) == 5


def test_equal_buckets_are_not_read_again(spark, tmp_path):
    expected = spark.range(5000).selectExpr("id as k", "id * 2 as v")
    actual = expected.withColumn("v", F.when(F.col("k") == 77, 0).otherwise(F.col("v")))
    found = reconcile(expected, actual, "k", ["v"], str(tmp_path / "d"))
    assert rows(found) == [(77, "stale")]
    sides = [store_digests(df, "k", ["v"], str(tmp_path / n)) for n, df in (("x", expected), ("y", actual))]
    assert len(differing_buckets(*sides)) == 1 and len({f.rsplit("/", 2)[1] for f in sides[0].inputFiles()}) == 64
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan


@pytest.mark.parametrize(
    ("accepted", "incoming", "change"),
    [
        ("int", "int", "same"), ("int", "bigint", "promoted"), ("bigint", "int", "narrower"), ("bigint", "decimal(20,0)", "promoted"),
        ("decimal(10,2)", "decimal(12,2)", "promoted"), ("date", "timestamp_ntz", "promoted"), ("float", "double", "promoted"),
        ("bigint", "double", "changed"), ("int", "string", "changed"), ("string", "int", "changed"), ("decimal(10,2)", "decimal(9,4)", "changed"),
    ],
)
def test_type_changes(spark, accepted, incoming, change):
    types = [spark.createDataFrame([], f"x {t}").schema["x"].dataType for t in (accepted, incoming)]
    assert type_change(*types) == change


def test_history_of_accepted_schemas(spark, tmp_path):
    history = SchemaHistory(spark, str(tmp_path / "h"))
    schema = lambda text: spark.createDataFrame([], text).schema
    assert history.versions() == [] and history.accept(schema("a int, b string")) == 1
    assert history.status(schema("B string, a int")) == "no_change" and history.accept(schema("b string, a int")) == 1
    assert history.accept(schema("c date, a bigint, b string")) == 2
    assert history.versions()[-1] == schema("a bigint, b string, c date")
    assert history.accept(schema("a int, b string, c date")) == 2  # an older, narrower shape still fits
    with pytest.raises(BreakingSchema, match="b: removed"):
        history.accept(schema("a int, c date"))
    assert history.accept(schema("a int"), allow_breaking=True) == 3 and len(history.versions()) == 3
    judged = history.judge(spark.createDataFrame([(1, "x"), (None, "y")], "a int, d string"))
    assert rows(judged) == [("a", "same", "no_change", 1), ("d", "added", "additive", 2)]


def test_all_failures_come_from_one_scan_of_rows(spark, tmp_path):
    spark.createDataFrame([(1, 5.0, "x"), (1, -1.0, "y"), (None, None, "z"), (2, None, None)], "transaction_id int, amount double, note string").write.parquet(str(tmp_path / "fct"))
    facts = spark.read.parquet(str(tmp_path / "fct"))
    rules = [r for r in quality.MART_RULES if r.table == "fct_transactions"]
    found = quality.tagged_failures({"fct_transactions": facts}, rules)
    lines = rows(found.select("rule_name", "value", "n_records"))
    assert lines == [
        ("accepted_range_fct_transactions_amount", "-1.0", 1), ("not_null_fct_transactions_amount", None, 1), ("not_null_fct_transactions_amount", None, 1),
        ("not_null_fct_transactions_transaction_id", None, 1), ("unique_fct_transactions_transaction_id", "1", 2),
    ]
    leaves = found._jdf.queryExecution().optimizedPlan().collectLeaves()
    scans = [leaves.apply(i).toString() for i in range(leaves.size())]
    plan = found._jdf.queryExecution().executedPlan().toString()
    schemas = [part.split(">")[0] for part in plan.split("ReadSchema: ")[1:]]
    assert len(scans) == 2 and sorted("note" in s for s in schemas) == [False, True]  # one scan of rows, one of keys alone
    folder = quality.store_tagged_failures({"fct_transactions": facts}, rules, folder=str(tmp_path / "out"))
    stored = spark.read.parquet(folder).where("rule_name = 'accepted_range_fct_transactions_amount'").first()
    assert stored.record == '{"transaction_id":1,"amount":-1.0,"note":"y"}'


@pytest.mark.parametrize("package", ["regex", "xxhash", "tokenizers", "public_tokenizers"])
def test_the_entry_stands_a_missing_optional_package(package):
    code = f"import sys; sys.modules['{package}'] = None; import __spark_entry__ as e; print(len(e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[1], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0 and int(done.stdout) > 50


def test_a_warehouse_on_the_drivers_disk_is_refused_on_a_cluster():
    for folder in ("file:/tmp/warehouse", "/tmp/warehouse"):
        assert workspace._is_shared(folder, "local[4]") and not workspace._is_shared(folder, "spark://host:7077")
    assert workspace._is_shared("hdfs://nn/warehouse", "yarn")
