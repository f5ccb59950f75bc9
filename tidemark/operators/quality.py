"""Declarative data-quality rules: counts, failing rows, a stored copy of the failures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import column, quoted, report_rows, text
from tidemark.sinks.tables import overwrite_path, overwrite_table

UNIQUE = "unique"
NOT_NULL = "not_null"
ACCEPTED_RANGE = "accepted_range"
RELATIONSHIPS = "relationships"


@dataclass(frozen=True)
class Rule:
    """One check on one column of one table."""

    kind: str
    table: str
    column: str
    min_value: float | None = None
    max_value: float | None = None
    parent: str | None = None
    parent_column: str | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.table}_{self.column}"


# The rules the marts are held to.
MART_RULES = (
    Rule(UNIQUE, "dim_accounts", "account_id"),
    Rule(NOT_NULL, "dim_accounts", "account_id"),
    Rule(NOT_NULL, "dim_accounts", "user_id"),
    Rule(RELATIONSHIPS, "dim_accounts", "user_id", parent="dim_users", parent_column="user_id"),
    Rule(UNIQUE, "dim_users", "user_id"),
    Rule(NOT_NULL, "dim_users", "user_id"),
    Rule(UNIQUE, "fct_transactions", "transaction_id"),
    Rule(NOT_NULL, "fct_transactions", "transaction_id"),
    Rule(NOT_NULL, "fct_transactions", "amount"),
    Rule(ACCEPTED_RANGE, "fct_transactions", "amount", min_value=0),
)


def row_violation(rule: Rule) -> str:
    """Predicate of a rule that can be judged row by row; range bounds are inclusive and nulls pass."""
    value = quoted(rule.column)
    if rule.kind == NOT_NULL:
        return f"{value} is null"
    if rule.kind == ACCEPTED_RANGE:
        below = [] if rule.min_value is None else [f"{value} < {rule.min_value}"]
        above = [] if rule.max_value is None else [f"{value} > {rule.max_value}"]
        if not below + above:
            raise ValueError(f"{rule.name} has no bound")
        return " or ".join(below + above)
    raise ValueError(f"{rule.kind} is not a row rule")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys present more than once, with their count. Null keys do not count as duplicates."""
    return (
        df.where(column(key).isNotNull())
        .groupBy(column(key))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where("n_records > 1")
    )


def orphan_keys(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys without a parent, with their row count. Null keys are not orphans.

    Children are counted per key before the join, so a key held by many rows joins as one.
    """
    counted = child.where(column(key).isNotNull()).groupBy(column(key)).agg(F.count(F.lit(1)).alias("n_records"))
    return counted.join(parent.select(column(parent_key).alias(key)), key, "left_anti")


def failing_rows(frames: Mapping[str, DataFrame], rule: Rule) -> DataFrame:
    """What a rule finds: whole rows for row rules, keys and counts for unique and relationships."""
    df = frames[rule.table]
    if rule.kind == UNIQUE:
        return duplicate_keys(df, rule.column)
    if rule.kind == RELATIONSHIPS:
        return orphan_keys(df, rule.column, frames[rule.parent], rule.parent_column)
    return df.where(row_violation(rule))


def quality_report(frames: Mapping[str, DataFrame], rules: Sequence[Rule] = MART_RULES) -> DataFrame:
    """One row per rule with the number of failures.

    All row rules of a table share one pass, and with them its first unique rule: rows are counted per
    key, partially before the shuffle, and the counts are summed up.
    """
    tables = list(dict.fromkeys(rule.table for rule in rules))
    reports = []
    for table in tables:
        own = [rule for rule in rules if rule.table == table]
        unique = [rule for rule in own if rule.kind == UNIQUE]
        by_row = [rule for rule in own if rule.kind in (NOT_NULL, ACCEPTED_RANGE)]
        reports.append(_table_report(frames[table], unique[:1], by_row))
        reports.extend(_table_report(frames[table], [rule], []) for rule in unique[1:])
        reports.extend(_relationship_report(frames, rule) for rule in own if rule.kind == RELATIONSHIPS)
    return reduce(DataFrame.unionByName, [r for r in reports if r is not None])


def _table_report(df: DataFrame, unique: Sequence[Rule], by_row: Sequence[Rule]) -> DataFrame | None:
    if not unique and not by_row:
        return None
    per_row = [f"count_if({row_violation(rule)}) as rule_{i}" for i, rule in enumerate(by_row)]
    counted = list(by_row)
    if not unique:
        totals = df.selectExpr(*per_row)
    else:
        key = df.groupBy(column(unique[0].column).alias("__key"))
        grouped = key.agg(F.expr("count(1) as n_records"), *map(F.expr, per_row))
        totals = grouped.selectExpr(
            *[f"coalesce(sum(rule_{i}), 0L) as rule_{i}" for i in range(len(by_row))],
            f"count_if(__key is not null and n_records > 1) as rule_{len(by_row)}",
        )
        counted.append(unique[0])
    return totals.selectExpr(report_rows(_line(rule, f"rule_{i}") for i, rule in enumerate(counted)))


def _relationship_report(frames: Mapping[str, DataFrame], rule: Rule) -> DataFrame:
    total = failing_rows(frames, rule).selectExpr("coalesce(sum(n_records), 0L) as total")
    return total.selectExpr(report_rows([_line(rule, "total")]))


def _line(rule: Rule, failures: str) -> dict[str, str]:
    return {
        "rule_name": text(rule.name),
        "table_name": text(rule.table),
        "column_name": text(rule.column),
        "rule_kind": text(rule.kind),
        "failures": failures,
    }


def tagged_failures(frames: Mapping[str, DataFrame], rules: Sequence[Rule] = MART_RULES) -> DataFrame:
    """(``rule_name``, ``value``, ``n_records``, ``record``): what all rules find, as one frame.

    Each row of a table carries the array of the row rules it breaks, so one scan serves them all, and the scan
    gets their disjunction as a filter. Keys of unique and relationship rules come from counts by key, for which
    the key column alone is read. ``record`` is the whole row as JSON, null where keys are counted.
    """
    parts = []
    for table in dict.fromkeys(rule.table for rule in rules):
        own = [rule for rule in rules if rule.table == table]
        by_row = [rule for rule in own if rule.kind in (NOT_NULL, ACCEPTED_RANGE)]
        if by_row:
            parts.append(_tagged_rows(frames[table], by_row))
        for rule in own:
            if rule not in by_row:
                value = f"cast({quoted(rule.column)} as string) as value"
                found = failing_rows(frames, rule)
                parts.append(found.selectExpr(f"{text(rule.name)} as rule_name", value, "n_records", "cast(null as string) as record"))
    return reduce(DataFrame.unionByName, parts)


def _tagged_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    broken = [row_violation(rule) for rule in rules]
    tags = [
        f"case when {test} then struct({text(rule.name)} as rule_name, cast({quoted(rule.column)} as string) as value) end"
        for rule, test in zip(rules, broken, strict=True)
    ]
    record = ", ".join(map(quoted, df.columns))
    failing = df.where(" or ".join(f"({test})" for test in broken))
    tagged = failing.selectExpr(f"to_json(struct({record})) as record", f"explode(filter(array({', '.join(tags)}), x -> x is not null)) as tag")
    return tagged.selectExpr("tag.rule_name", "tag.value", "1L as n_records", "record")


def store_tagged_failures(frames: Mapping[str, DataFrame], rules: Sequence[Rule] = MART_RULES, *, folder: str) -> str:
    """All failures in one job, one folder for each rule that has any."""
    tagged_failures(frames, rules).write.partitionBy("rule_name").mode("overwrite").parquet(folder)
    return folder


def store_failures(
    frames: Mapping[str, DataFrame],
    rules: Sequence[Rule] = MART_RULES,
    schema: str | None = None,
    folder: str | None = None,
) -> dict[str, str]:
    """Write what each rule finds to a table in ``schema`` or a path under ``folder``; returns where."""
    if (schema is None) == (folder is None):
        raise ValueError("give either a schema or a folder")
    stored = {}
    for rule in rules:
        rows = failing_rows(frames, rule)
        if schema is not None:
            stored[rule.name] = overwrite_table(rows, f"{schema}.{rule.name}")
        else:
            stored[rule.name] = overwrite_path(rows, f"{folder}/{rule.name}")
    return stored
