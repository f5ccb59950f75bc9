"""Accepted schemas of a source, version by version, and what a delivery changes against the last of them.

A type may rise to one that holds all its values (an int to a bigint, a bigint to a decimal of twenty digits, a
date to a timestamp), so such a change adds to the schema and breaks nothing; text, which holds anything, is no
such step. A narrower type than the accepted one fits it as it is.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

from tidemark.functions import quoted, report_rows, same_name, text
from tidemark.sinks.versioned import VersionedTable
from tidemark.sources.parquet import widen

ADDITIVE = "additive"
BREAKING = "breaking"
NO_CHANGE = "no_change"

#: What becomes of a column, and what that means for the tables that hold it.
VERDICTS = {"same": NO_CHANGE, "narrower": NO_CHANGE, "added": ADDITIVE, "promoted": ADDITIVE, "removed": BREAKING, "changed": BREAKING}

_ROWS = "version int, place int, column_name string, data_type string"


class BreakingSchema(ValueError):
    """A delivery that does not fit the accepted schema."""


def type_change(accepted: DataType, incoming: DataType) -> str:
    """``same``, ``promoted``, ``narrower`` or ``changed``."""
    if accepted == incoming:
        return "same"
    common = widen(accepted, incoming)
    if isinstance(common, StringType):
        return "changed"
    return "promoted" if common == incoming else "narrower" if common == accepted else "changed"


class SchemaHistory:
    """The accepted schemas stored at ``path``, oldest first. Accepting one is a publish, so readers see it whole."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.table = spark, VersionedTable(spark, path)

    def versions(self) -> list[StructType]:
        """As many as were ever accepted: schema metadata."""
        if self.table.head() is None:
            return []
        found: dict[int, list[StructField]] = {}
        for r in self.table.read().orderBy("version", "place").collect():
            found.setdefault(r.version, []).append(StructField(r.column_name, _type_of(r.data_type)))
        return [StructType(found[v]) for v in sorted(found)]

    def changes(self, incoming: StructType) -> dict[str, str]:
        """Each column of the last accepted schema and of ``incoming``, and what becomes of it."""
        known = self.versions()
        fold = same_name(self.spark)
        accepted = {fold(f.name): f for f in (known[-1] if known else StructType())}
        arrived = {fold(f.name): f for f in incoming}
        found = {}
        for name, field in (accepted | arrived).items():
            if name not in accepted:
                found[field.name] = "added"
            elif name not in arrived:
                found[field.name] = "removed"
            else:
                found[accepted[name].name] = type_change(accepted[name].dataType, arrived[name].dataType)
        return found

    def judge(self, incoming: DataFrame) -> DataFrame:
        """(``column_name``, ``change``, ``verdict``, ``filled_rows``): the changes, and in how many rows of the delivery
        each column holds a value. One pass."""
        fold = same_name(self.spark)
        present = {fold(c): c for c in incoming.columns}
        changes = self.changes(incoming.schema)
        counts = [f"count({quoted(present[fold(c)])}) as filled_{i}" if fold(c) in present else f"0L as filled_{i}" for i, c in enumerate(changes)]
        lines = [
            {"column_name": text(c), "change": text(change), "verdict": text(VERDICTS[change]), "filled_rows": f"filled_{i}"}
            for i, (c, change) in enumerate(changes.items())
        ]
        return incoming.selectExpr(*counts).selectExpr(report_rows(lines))

    def status(self, incoming: StructType) -> str:
        verdicts = {VERDICTS[change] for change in self.changes(incoming).values()}
        return BREAKING if BREAKING in verdicts else ADDITIVE if ADDITIVE in verdicts else NO_CHANGE

    def accept(self, incoming: StructType, allow_breaking: bool = False) -> int:
        """The number of the accepted schema that covers ``incoming``: the last one, or a new one with promoted types
        and added columns behind the known ones. A breaking delivery is refused, or starts from its own schema."""
        known, status = self.versions(), self.status(incoming)
        if status == NO_CHANGE and known:
            return len(known)
        if status == BREAKING and not allow_breaking:
            raise BreakingSchema(", ".join(f"{c}: {change}" for c, change in self.changes(incoming).items() if VERDICTS[change] == BREAKING))
        fold = same_name(self.spark)
        arrived = {fold(f.name): f for f in incoming}
        fields = list(incoming)
        if known and status == ADDITIVE:
            kept = [StructField(f.name, widen(f.dataType, arrived[fold(f.name)].dataType)) for f in known[-1]]
            old = {fold(f.name) for f in known[-1]}
            fields = kept + [f for f in incoming if fold(f.name) not in old]
        lines = [(v, i, f.name, json.dumps(f.dataType.jsonValue())) for v, schema in enumerate([*known, StructType(fields)], 1) for i, f in enumerate(schema)]
        self.table.replace(self.spark.createDataFrame(lines, _ROWS).coalesce(1))
        return len(known) + 1


def _type_of(stored: str) -> DataType:
    return StructType.fromJson({"type": "struct", "fields": [{"name": "x", "type": json.loads(stored), "nullable": True, "metadata": {}}]})[0].dataType


def judged_in_turn(spark: SparkSession, path: str, deliveries: list[DataFrame]) -> DataFrame:
    """Every delivery judged against what was accepted before it, and accepted if it breaks nothing."""
    history, found = SchemaHistory(spark, path), None
    for number, delivery in enumerate(deliveries, 1):
        judged = history.judge(delivery).select(F.lit(number).alias("delivery"), "*")
        found = judged if found is None else found.unionByName(judged)
        if history.status(delivery.schema) != BREAKING:
            history.accept(delivery.schema)
    return found
