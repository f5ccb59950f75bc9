"""Schema comparison, drift, contract, harmonizing and name collisions."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from tidemark.functions import column, is_lossy, loses_value, quoted, report_rows, same_name, text, typed_null
from tidemark.schemas import CONTRACT

MISSING_IN_FIRST = "missing_in_first"
MISSING_IN_SECOND = "missing_in_second"
TYPE_DIFFERS = "type_differs"


def schema_issues(first: DataFrame, second: DataFrame) -> dict[str, str | None]:
    """Issue per column of either frame, ``None`` where the two agree. Nullability is not compared."""
    fold = same_name(first.sparkSession)
    left = {fold(f.name): f for f in first.schema}
    right = {fold(f.name): f for f in second.schema}
    issues: dict[str, str | None] = {}
    for key in left | right:
        name = (left.get(key) or right[key]).name
        if key not in left:
            issues[name] = MISSING_IN_FIRST
        elif key not in right:
            issues[name] = MISSING_IN_SECOND
        elif left[key].dataType != right[key].dataType:
            issues[name] = TYPE_DIFFERS
        else:
            issues[name] = None
    return issues


def compare_schemas(first: DataFrame, second: DataFrame) -> list[str]:
    """The differences in words, sorted; an empty list if there are none."""
    fold = same_name(first.sparkSession)
    left = {fold(f.name): f.dataType for f in first.schema}
    right = {fold(f.name): f.dataType for f in second.schema}
    wording = {
        MISSING_IN_FIRST: "{name}: only the second frame has it",
        MISSING_IN_SECOND: "{name}: only the first frame has it",
        TYPE_DIFFERS: "{name}: {first} in the first frame, {second} in the second",
    }
    return sorted(
        wording[issue].format(name=name, first=left.get(fold(name)), second=right.get(fold(name)))
        for name, issue in schema_issues(first, second).items()
        if issue
    )


def schema_drift(incoming: DataFrame, target: DataFrame) -> DataFrame:
    """What each schema difference means for the data.

    One row per column of either frame: its issue, the incoming rows that hold a value, and those whose
    value would be lost by conversion to the target's type. All counts come from one pass.
    """
    fold = same_name(incoming.sparkSession)
    present = {fold(f.name): f.name for f in incoming.schema}
    target_types = {fold(f.name): f.dataType for f in target.schema}
    issues = schema_issues(incoming, target)

    counts, rows = [], []
    for i, (name, issue) in enumerate(issues.items()):
        held = f"count({quoted(name)})" if fold(name) in present else "0L"
        lost = _lost(incoming, present[fold(name)], target_types[fold(name)]) if issue == TYPE_DIFFERS else "0L"
        counts += [f"{held} as held_{i}", f"{lost} as lost_{i}"]
        rows.append(
            {
                "column_name": text(name),
                "issue": text(issue or "none"),
                "incoming_rows": f"held_{i}",
                "lossy_rows": f"lost_{i}",
            }
        )
    return incoming.selectExpr(*counts).selectExpr(report_rows(rows))


def _lost(df: DataFrame, name: str, target: DataType) -> str:
    """Count of values that a conversion to ``target`` drops or cuts; all of them if the types have none.

    Types that convert one way only, and those that do not compare, are judged by the conversion alone.
    """
    for lossy in (loses_value(name, df.schema[name].dataType, target), is_lossy(name, target)):
        try:
            df.selectExpr(f"count_if({lossy})")
        except AnalysisException:
            continue
        return f"count_if({lossy})"
    return f"count({quoted(name)})"


def drift_status(drift: DataFrame) -> DataFrame:
    """One status for a drift report: ``no_change``, ``additive`` (only new columns) or ``breaking``."""
    breaking = F.count_if(F.col("issue").isin(MISSING_IN_FIRST, TYPE_DIFFERS))
    added = F.count_if(F.col("issue") == MISSING_IN_SECOND)
    return drift.agg(
        F.when(breaking > 0, "breaking").when(added > 0, "additive").otherwise("no_change").alias("status"),
        F.count_if(F.col("issue") != "none").alias("changed_columns"),
        F.coalesce(F.sum("lossy_rows"), F.lit(0)).cast("bigint").alias("lossy_rows"),
    )


class ContractViolation(ValueError):
    """A delivery lacks required tables or columns."""


def contract_violations(
    frames: Mapping[str, DataFrame], contract: Mapping[str, Collection[str]] = CONTRACT
) -> list[tuple[str, str | None]]:
    """Missing (table, column) pairs, the column being ``None`` if the table is missing.

    Tables and columns the contract does not name are tolerated. Names compare exactly, as in the source.
    """
    missing: list[tuple[str, str | None]] = []
    for table, required in contract.items():
        if table not in frames:
            missing.append((table, None))
        else:
            present = set(frames[table].columns)
            missing.extend((table, name) for name in required if name not in present)
    return missing


def enforce_contract(
    frames: Mapping[str, DataFrame], contract: Mapping[str, Collection[str]] = CONTRACT
) -> None:
    """Stop before any load if the delivery breaks the contract."""
    missing = contract_violations(frames, contract)
    if missing:
        raise ContractViolation("missing: " + ", ".join(t if c is None else f"{t}.{c}" for t, c in missing))


def contract_check(
    frames: Mapping[str, DataFrame],
    contract: Mapping[str, Collection[str]] = CONTRACT,
    spark: SparkSession | None = None,
) -> DataFrame:
    """Per required column: is it there, and how many rows hold a value. One pass per table.

    A delivery without any table lacks every column; ``spark`` is then the session given, or the active one.
    """
    spark = spark or next((f.sparkSession for f in frames.values()), None) or SparkSession.active()
    missing = set(contract_violations(frames, contract))
    reports = []
    for table, required in contract.items():
        absent = {c for c in required if (table, None) in missing or (table, c) in missing}
        counted = {c: f"held_{i}" for i, c in enumerate(required) if c not in absent}
        rows = [
            {
                "table_name": text(table),
                "column_name": text(c),
                "present": "false" if c in absent else "true",
                "non_null_rows": counted.get(c, "0L"),
            }
            for c in required
        ]
        counts = [f"count({quoted(c)}) as {held}" for c, held in counted.items()]
        base = frames[table].selectExpr(*counts) if counts else spark.range(1)
        reports.append(base.selectExpr(report_rows(rows)))
    return reduce(DataFrame.unionByName, reports)


def harmonize_schema(incoming: DataFrame, production: DataFrame) -> DataFrame:
    """Incoming rows in production's shape: its columns in its order, then the incoming-only ones.

    Columns the delivery lacks become nulls of production's type. A column both have keeps the incoming
    type, even if production's differs.
    """
    fold = same_name(incoming.sparkSession)
    present = {fold(f.name): f.name for f in incoming.schema}
    known = {fold(f.name) for f in production.schema}
    aligned = [
        (column(present[fold(f.name)]) if fold(f.name) in present else typed_null(f.dataType)).alias(f.name)
        for f in production.schema
    ]
    extra = [column(name) for key, name in present.items() if key not in known]
    return incoming.select(*aligned, *extra)


def resolve_collisions(
    main: DataFrame,
    update: DataFrame,
    join_keys: Collection[str],
    main_prefix: str = "prod_",
    update_prefix: str = "incoming_",
) -> tuple[DataFrame, DataFrame]:
    """Prefix the columns both frames have, keys excepted, so that a join keeps them apart.

    Names clash as the session resolves them. A prefixed name that either frame has already is an error.
    """
    fold = same_name(main.sparkSession)
    keys = {fold(k) for k in join_keys}
    clashing = ({fold(c) for c in main.columns} & {fold(c) for c in update.columns}) - keys
    renamed = []
    taken: set[str] = set()
    for df, prefix in ((main, main_prefix), (update, update_prefix)):
        names = [prefix + c if fold(c) in clashing else c for c in df.columns]
        for name in names:
            if fold(name) in taken and fold(name) not in keys:
                raise ValueError(f"the prefixed name {name} is taken by another column")
            taken.add(fold(name))
        renamed.append(df.select(*[column(c).alias(n) for c, n in zip(df.columns, names, strict=True)]))
    return renamed[0], renamed[1]
