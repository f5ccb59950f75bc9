import pytest
from conftest import rows

from tidemark.operators.schema_ops import (
    ContractViolation,
    compare_schemas,
    contract_check,
    contract_violations,
    drift_status,
    enforce_contract,
    harmonize_schema,
    resolve_collisions,
    schema_drift,
)


def frame(spark, schema, *lines):
    return spark.createDataFrame(list(lines), schema)


def test_compare_schemas(spark):
    first, second = frame(spark, "a int, b string"), frame(spark, "a bigint, c string")
    assert compare_schemas(first, second) == [
        "a: IntegerType() in the first frame, LongType() in the second",
        "b: only the first frame has it",
        "c: only the second frame has it",
    ]
    assert compare_schemas(first, first) == []


def test_names_follow_the_session(spark, settings):
    first, second = frame(spark, "ID int"), frame(spark, "id int")
    assert compare_schemas(first, second) == []
    assert harmonize_schema(first, second).columns == ["id"]
    settings(spark__sql__caseSensitive="true")
    assert len(compare_schemas(first, second)) == 2
    assert harmonize_schema(first, second).columns == ["id", "ID"]


def test_schema_drift_counts(spark):
    incoming = frame(spark, "a string, b string, n int", ("1", "x", None), ("oops", None, 2), (None, "y", 3))
    target = frame(spark, "a int, c string, n int")
    assert rows(schema_drift(incoming, target)) == [
        ("a", "type_differs", 2, 1),
        ("b", "missing_in_second", 2, 0),
        ("c", "missing_in_first", 0, 0),
        ("n", "none", 2, 0),
    ]


def test_types_without_a_conversion_lose_everything(spark):
    incoming = spark.sql("select array(1, 2) as a union all select null")
    assert rows(schema_drift(incoming, frame(spark, "a int"))) == [("a", "type_differs", 1, 1)]


@pytest.mark.parametrize(
    "schema, status", [("a int", "no_change"), ("a int, b int", "additive"), ("b int", "breaking"), ("a bigint", "breaking")]
)
def test_drift_status(spark, schema, status):
    drift = schema_drift(frame(spark, schema), frame(spark, "a int"))
    assert drift_status(drift).first().status == status


CONTRACT = {"t": ("id", "_ab_cdc_lsn"), "u": ("id",)}


def test_contract(spark):
    frames = {"t": frame(spark, "id int, extra int", (1, 1), (None, 2)), "other": frame(spark, "x int")}
    assert contract_violations(frames, CONTRACT) == [("t", "_ab_cdc_lsn"), ("u", None)]
    assert rows(contract_check(frames, CONTRACT)) == [
        ("t", "_ab_cdc_lsn", False, 0), ("t", "id", True, 1), ("u", "id", False, 0),
    ]
    with pytest.raises(ContractViolation, match="t._ab_cdc_lsn, u"):
        enforce_contract(frames, CONTRACT)
    enforce_contract({"t": frame(spark, "id int, _ab_cdc_lsn int"), "u": frame(spark, "id int")}, CONTRACT)


def test_contract_of_an_empty_delivery(spark):
    for found in (contract_check({}, CONTRACT, spark), contract_check({}, CONTRACT)):
        assert rows(found) == [("t", "_ab_cdc_lsn", False, 0), ("t", "id", False, 0), ("u", "id", False, 0)]


@pytest.mark.parametrize(
    "source, values, target, lossy",
    [
        ("double", (1.5, 2.0, None, float("nan")), "bigint", 2),
        ("string", ("1.23456789012", "1.5", "1.50000000000000", "1e-12", "1e2", "x", None), "decimal(38,9)", 3),
        ("string", ("1", "1.5", "2.0"), "bigint", 2),
        ("string", ("2024-01-01 10:00:00", "2024-01-01", "2024-01-01 00:00:00", "x"), "date", 2),
        ("string", ("0.1", "x"), "double", 1),
        ("int", (1, 2), "map<int,int>", 2),
        ("bigint", (1, 1 << 40), "int", 1),
    ],
)
def test_drift_counts_cut_values(spark, source, values, target, lossy):
    drift = schema_drift(frame(spark, f"a {source}", *[(v,) for v in values]), frame(spark, f"a {target}"))
    assert drift.first().lossy_rows == lossy


def test_drift_counts_cut_times_of_day(spark):
    clocks = spark.sql("select timestamp_ntz '2024-01-01 10:00:00' as a union all select timestamp_ntz '2024-01-01 00:00:00'")
    assert schema_drift(clocks, frame(spark, "a date")).first().lossy_rows == 1


def test_harmonize(spark):
    incoming = frame(spark, "b string, x int", ("v", 1))
    production = frame(spark, "a double, b string")
    found = harmonize_schema(incoming, production)
    assert [(f.name, f.dataType.simpleString()) for f in found.schema] == [("a", "double"), ("b", "string"), ("x", "int")]
    assert rows(found) == [(None, "v", 1)]


def test_harmonize_keeps_the_incoming_type(spark):
    found = harmonize_schema(frame(spark, "a string"), frame(spark, "a int"))
    assert found.schema["a"].dataType.simpleString() == "string"


def test_odd_column_names(spark):
    incoming = frame(spark, "`a.b` int, `c d` string", (1, "x"))
    assert harmonize_schema(incoming, frame(spark, "`c d` string, `e``f` int")).columns == ["c d", "e`f", "a.b"]
    assert rows(schema_drift(incoming, frame(spark, "`a.b` bigint")))[0] == ("a.b", "type_differs", 1, 0)


def test_resolve_collisions(spark):
    main, update = frame(spark, "id int, created_at int, n int"), frame(spark, "id int, created_at int, m int")
    left, right = resolve_collisions(main, update, ["id"])
    assert left.columns == ["id", "prod_created_at", "n"]
    assert right.columns == ["id", "incoming_created_at", "m"]
    same = resolve_collisions(main.drop("created_at"), update, ["id"])
    assert [f.columns for f in same] == [["id", "n"], ["id", "created_at", "m"]]


def test_collisions_match_names_as_the_session_does(spark):
    left, right = resolve_collisions(frame(spark, "id int, country int"), frame(spark, "id int, Country int"), ["id"])
    assert (left.columns, right.columns) == (["id", "prod_country"], ["id", "incoming_Country"])
    assert left.join(right, "id").columns == ["id", "prod_country", "incoming_Country"]


def test_a_taken_prefixed_name_is_an_error(spark):
    with pytest.raises(ValueError, match="prod_c"):
        resolve_collisions(frame(spark, "id int, c int, prod_c int"), frame(spark, "id int, c int"), ["id"])
