import random

import pytest
from conftest import final_plan, rows
from hypothesis import HealthCheck, given, settings as hypothesis_settings, strategies as st

from tidemark.operators.joins import enrich_transactions, left_lookup, merge_upsert

NO_BROADCAST = {"spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1"}


def test_merge_nulls_never_overwrite(spark):
    main = spark.createDataFrame([(1, "a", None), (2, "b", 2), (3, None, 3)], "k int, s string, n int")
    update = spark.createDataFrame([(1, "z", 9), (2, None, 5), (4, "n", 4)], "k int, s string, n int")
    assert rows(merge_upsert(main, update, ["k"])) == [(1, "z", 9), (2, "b", 5), (3, None, 3), (4, "n", 4)]


def test_merge_null_keys_match_nothing(spark):
    main = spark.createDataFrame([(None, "m"), (1, "a")], "k int, s string")
    update = spark.createDataFrame([(None, "u"), (1, "b")], "k int, s string")
    assert rows(merge_upsert(main, update, ["k"])) == [(None, "m"), (None, "u"), (1, "b")]


def test_merge_column_sets(spark):
    main = spark.createDataFrame([(1, "a", 7)], "k int, s string, only_main int")
    update = spark.createDataFrame([(1, "b", 8), (2, "c", 9)], "k int, s string, only_update int")
    merged = merge_upsert(main, update, ["k"])
    assert merged.columns == ["k", "s", "only_main"]
    assert rows(merged) == [(1, "b", 7), (2, "c", None)]


def test_merge_widens_like_the_values(spark):
    main = spark.createDataFrame([(1, 1)], "k int, n int")
    update = spark.createDataFrame([(1, 5_000_000_000)], "k int, n bigint")
    assert rows(merge_upsert(main, update, ["k"])) == [(1, 5_000_000_000)]


def full_outer(main, update):
    """The upsert by brute force over (key, key, value) rows."""
    out = []
    for a, b, v in main:
        hits = [w for c, d, w in update if None not in (a, b) and (a, b) == (c, d)]
        out.extend((a, b, v if w is None else w) for w in hits or [v])
    known = {(a, b) for a, b, _ in main if None not in (a, b)}
    out.extend((a, b, w) for a, b, w in update if (a, b) not in known)
    return sorted(out, key=lambda r: tuple((x is not None, str(x)) for x in r))


cell = st.one_of(st.none(), st.integers(0, 2))
table = st.lists(st.tuples(cell, cell, cell), max_size=6)


@hypothesis_settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(table, table)
def test_merge_is_the_full_outer_join(spark, main, update):
    schema = "a int, b int, v int"
    found = merge_upsert(spark.createDataFrame(main, schema), spark.createDataFrame(update, schema), ["a", "b"])
    assert rows(found) == full_outer(main, update)


def test_merge_of_a_large_update_without_broadcast(spark, settings):
    settings(**NO_BROADCAST)
    generator = random.Random(3)
    main = [(generator.randrange(50) if i % 3 else 7, 0, i) for i in range(300)]
    update = [(k, 0, None if k % 5 == 0 else -k) for k in range(40, 60)] + [(7, 0, 99)]
    schema = "a int, b int, v int"
    found = merge_upsert(spark.createDataFrame(main, schema), spark.createDataFrame(update, schema), ["a", "b"])
    assert rows(found) == full_outer(main, update)


def accounts(spark, n=100):
    return spark.range(n).selectExpr("id as account_id", "id + 1000 as user_id")


def test_enrich_keeps_unmatched_and_null_keys(spark):
    facts = spark.createDataFrame(
        [(1, 1, 2), (2, 1, 999), (3, None, 3), (4, None, None)],
        "transaction_id bigint, from_account_id bigint, to_account_id bigint",
    )
    found = enrich_transactions(facts, accounts(spark))
    assert found.columns[-2:] == ["from_user_id", "to_user_id"]
    assert rows(found.select("transaction_id", "from_user_id", "to_user_id")) == [
        (1, 1001, 1002), (2, 1001, None), (3, None, 1003), (4, None, None),
    ]


@pytest.mark.parametrize("hot", ["7", "null"])
def test_a_hot_lookup_key_is_split(spark, settings, hot):
    """A third of the rows share an account, or have none: the work is spread and no row is lost."""
    settings(
        **NO_BROADCAST,
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    facts = spark.range(0, 120_000, 1, 8).selectExpr(
        "id as transaction_id", f"case when id % 3 = 0 then {hot} else id % 100 end as account", "uuid() as payload"
    )
    found = left_lookup(facts, accounts(spark), {"account": "account_id"}, {"user_id": "owner"}, ["transaction_id"])
    plan = final_plan(found)
    assert "SortMergeJoin" in plan
    if hot == "null":
        assert "skew=true" not in plan  # the null keys are spread beforehand
    else:
        assert "skew=true" in plan
    assert found.count() == 120_000
    assert found.where("account is not null and owner is distinct from account + 1000").isEmpty()
    assert found.where("account is null and owner is not null").isEmpty()


def test_both_lookups_share_one_shuffle_of_the_accounts(spark, settings):
    settings(**NO_BROADCAST)
    facts = spark.range(100).selectExpr("id as transaction_id", "id as from_account_id", "99 - id as to_account_id")
    owners = accounts(spark).groupBy("account_id").agg({"user_id": "max"}).toDF("account_id", "user_id")
    plan = final_plan(enrich_transactions(facts, owners))
    assert "ReusedExchange" in plan


def test_merge_matches_names_as_the_session_does(spark):
    main = spark.createDataFrame([(1, "a"), (2, "c")], "id int, country string")
    update = spark.createDataFrame([("b", 1), ("d", 3)], "Country string, ID int")
    found = merge_upsert(main, update, ["Id"])
    assert found.columns == ["id", "country"]
    assert rows(found) == [(1, "b"), (2, "c"), (3, "d")]


@pytest.mark.parametrize("hot", ["7", "null"])
def test_a_hot_key_of_a_merge_is_spread(spark, settings, hot):
    """A third of the update shares a key that ``main`` lacks, or has none: no task gets it all and none is lost."""
    settings(
        **NO_BROADCAST,
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    main = spark.range(1_000, 2_000).selectExpr("id", "'old' as payload")
    update = spark.range(0, 60_000, 1, 8).selectExpr(
        f"case when id % 3 = 0 then {hot} else id + 1500 end as id", "uuid() as payload"
    )
    found = merge_upsert(main, update, ["id"])
    plan = final_plan(found)
    assert "SortMergeJoin" in plan
    assert ("skew=true" in plan) == (hot == "7")  # the null keys are spread beforehand
    per_task = found.where("id is null").selectExpr("spark_partition_id() as task").groupBy("task").count()
    if hot == "null":
        assert per_task.agg({"count": "max"}).first()[0] < 5_000
    matched = sum(1 for i in range(60_000) if i % 3 and i + 1500 < 2_000)
    assert found.count() == 1_000 + 60_000 - matched
