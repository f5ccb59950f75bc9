import pytest
from conftest import final_plan, rows

from tidemark.operators.versions import latest_by_key

LOG = "k bigint, v string, _ab_cdc_lsn decimal(38,9), _ab_cdc_deleted_at timestamp, _airbyte_extracted_at int, _airbyte_raw_id string"


def log(spark, *lines):
    """Lines are (key, value, lsn, deleted, extracted, raw id)."""
    frame = spark.createDataFrame(
        [(k, v, lsn, deleted, ext, raw) for k, v, lsn, deleted, ext, raw in lines],
        "k bigint, v string, lsn int, deleted boolean, _airbyte_extracted_at int, _airbyte_raw_id string",
    )
    return frame.selectExpr(
        "k", "v", "cast(lsn as decimal(38,9)) as _ab_cdc_lsn",
        "case when deleted then timestamp'2024-06-01' end as _ab_cdc_deleted_at",
        "_airbyte_extracted_at", "_airbyte_raw_id",
    )


def kept(df):
    return rows(df.select("k", "v"))


def test_highest_lsn_wins_then_extraction_then_raw_id(spark):
    df = log(
        spark,
        (1, "old", 1, False, 9, "z"), (1, "new", 2, False, 1, "a"),
        (2, "early", 5, False, 1, "z"), (2, "late", 5, False, 2, "a"),
        (3, "low", 5, False, 1, "a"), (3, "high", 5, False, 1, "b"),
    )
    assert kept(latest_by_key(df, "k")) == [(1, "new"), (2, "late"), (3, "high")]


def test_null_lsn_ranks_last(spark):
    df = log(spark, (1, "none", None, False, 9, "b"), (1, "some", 0, False, 1, "a"))
    assert kept(latest_by_key(df, "k")) == [(1, "some")]


def test_tombstone_policies(spark):
    df = log(spark, (1, "v0", 1, False, 1, "a"), (1, "v1", 2, True, 2, "b"), (2, "w", 1, False, 1, "c"))
    assert kept(latest_by_key(df, "k")) == [(1, "v0"), (2, "w")]
    assert kept(latest_by_key(df, "k", tombstones="rank_first")) == [(2, "w")]
    assert kept(latest_by_key(df, "k", tombstones=None)) == [(1, "v1"), (2, "w")]
    with pytest.raises(ValueError):
        latest_by_key(df, "k", tombstones="other")


def test_null_keys_are_one_key(spark):
    df = log(spark, (None, "x", 1, False, 1, "a"), (None, "y", 2, False, 1, "b"))
    assert kept(latest_by_key(df, "k")) == [(None, "y")]


def test_compound_key(spark):
    df = log(spark, (1, "a", 1, False, 1, "p"), (1, "a", 2, False, 1, "q"), (1, "b", 1, False, 1, "r"))
    assert rows(latest_by_key(df, ["k", "v"]).select("_airbyte_raw_id")) == [("q",), ("r",)]


def test_hot_key_is_cut_before_the_shuffle(spark):
    """A third of all rows share one key; each map task ships one of them."""
    df = spark.range(0, 90_000, 1, 8).selectExpr(
        "case when id % 3 = 0 then -1 else id end as k", "'v' as v", "cast(id as decimal(38,9)) as _ab_cdc_lsn",
        "cast(null as timestamp) as _ab_cdc_deleted_at", "1 as _airbyte_extracted_at", "string(id) as _airbyte_raw_id",
    )
    latest = latest_by_key(df, "k")
    plan = final_plan(latest)
    assert plan.index("Final") < plan.index("Partial") and "WindowGroupLimit" in plan
    assert latest.count() == 60_001
    assert rows(latest.where("k = -1").selectExpr("int(_ab_cdc_lsn)")) == [(89_997,)]
