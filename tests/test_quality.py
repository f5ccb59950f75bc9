import pytest
from conftest import rows

from tidemark.operators.quality import (
    ACCEPTED_RANGE,
    MART_RULES,
    NOT_NULL,
    RELATIONSHIPS,
    UNIQUE,
    Rule,
    failing_rows,
    quality_report,
    store_failures,
)


@pytest.fixture
def frames(spark):
    return {
        "child": spark.createDataFrame(
            [(1, 10, -1.0), (1, 10, 0.0), (2, 99, None), (None, None, 5.0), (None, 99, 7.0)],
            "id int, parent_id int, amount double",
        ),
        "parent": spark.createDataFrame([(10,), (None,)], "id int"),
    }


RULES = (
    Rule(UNIQUE, "child", "id"),
    Rule(NOT_NULL, "child", "id"),
    Rule(ACCEPTED_RANGE, "child", "amount", min_value=0),
    Rule(RELATIONSHIPS, "child", "parent_id", parent="parent", parent_column="id"),
    Rule(UNIQUE, "child", "parent_id"),
    Rule(NOT_NULL, "parent", "id"),
)


def test_failing_rows(frames):
    found = {rule.name: rows(failing_rows(frames, rule)) for rule in RULES}
    assert found == {
        "unique_child_id": [(1, 2)],
        "not_null_child_id": [(None, None, 5.0), (None, 99, 7.0)],
        "accepted_range_child_amount": [(1, 10, -1.0)],
        "relationships_child_parent_id": [(99, 2)],
        "unique_child_parent_id": [(10, 2), (99, 2)],
        "not_null_parent_id": [(None,)],
    }


def test_report(frames):
    found = {row.rule_name: row.failures for row in quality_report(frames, RULES).collect()}
    assert found == {
        "unique_child_id": 1,
        "not_null_child_id": 2,
        "accepted_range_child_amount": 1,
        "relationships_child_parent_id": 2,
        "unique_child_parent_id": 2,
        "not_null_parent_id": 1,
    }


def test_report_on_empty_tables(frames):
    empty = {name: frame.limit(0) for name, frame in frames.items()}
    assert {row.failures for row in quality_report(empty, RULES).collect()} == {0}


def test_range_bounds_are_inclusive_and_nulls_pass(spark):
    frames = {"t": spark.createDataFrame([(-1,), (0,), (None,), (5,), (6,)], "v int")}
    rule = Rule(ACCEPTED_RANGE, "t", "v", min_value=0, max_value=5)
    assert rows(failing_rows(frames, rule)) == [(-1,), (6,)]
    with pytest.raises(ValueError):
        failing_rows(frames, Rule(ACCEPTED_RANGE, "t", "v"))


def test_failures_are_stored(spark, frames, tmp_path):
    paths = store_failures(frames, RULES[:2], folder=str(tmp_path))
    assert rows(spark.read.parquet(paths["unique_child_id"])) == [(1, 2)]
    spark.sql("create database if not exists test_failures")
    tables = store_failures(frames, RULES[:1], schema="test_failures")
    assert rows(spark.table(tables["unique_child_id"])) == [(1, 2)]
    with pytest.raises(ValueError):
        store_failures(frames, RULES)


def test_the_mart_rules():
    assert len(MART_RULES) == 10 and len({rule.name for rule in MART_RULES}) == 10
