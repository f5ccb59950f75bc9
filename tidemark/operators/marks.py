"""High-water marks and the increment past them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from tidemark.functions import past_marks, quoted
from tidemark.operators.versions import latest_by_key, live_rows, project_current
from tidemark.schemas import EXTRACTED_AT, UPDATED_AT, Entity

UPDATED_CLOCK = "last_updated_at"
INGESTED_CLOCK = "ingested_at"


@dataclass(frozen=True)
class Marks:
    """The newest update and extraction time of a loaded table, as scalar expressions."""

    updated: Column
    ingested: Column

    @classmethod
    def deferred(cls, target: DataFrame) -> Marks:
        """Scalar subqueries: nothing runs until the query that uses them does."""
        marks = high_water_mark(target)
        return cls(marks.select(UPDATED_CLOCK).scalar(), marks.select(INGESTED_CLOCK).scalar())

    @classmethod
    def fetched(cls, target: DataFrame) -> Marks:
        """Literals from a one-row query, which the planner can use to skip files of the log."""
        clocks = (UPDATED_CLOCK, INGESTED_CLOCK)
        zoned = {c: not isinstance(target.schema[c].dataType, TimestampNTZType) for c in clocks}
        row = high_water_mark(target).select(
            *[(F.unix_micros(c) if zoned[c] else F.col(c).cast("string")).alias(c) for c in clocks]
        ).first()
        # Microseconds and text go through Python unchanged, unlike zoned datetimes.
        return cls(
            *[
                F.timestamp_micros(F.lit(row[c]).cast("bigint")) if zoned[c] else F.lit(row[c]).cast("timestamp_ntz")
                for c in clocks
            ]
        )

    def passed_by(self, updated: str, ingested: str) -> Column:
        return past_marks(self.updated, self.ingested, updated, ingested)


def high_water_mark(target: DataFrame) -> DataFrame:
    """Newest update and extraction time of a loaded table: one row, one pass, nulls if it is empty."""
    return target.agg(F.max(UPDATED_CLOCK).alias(UPDATED_CLOCK), F.max(INGESTED_CLOCK).alias(INGESTED_CLOCK))


def past_high_water_mark(current: DataFrame, marks: Marks) -> DataFrame:
    """Current rows strictly past either mark; an empty target's null marks let nothing through."""
    return current.where(marks.passed_by(UPDATED_CLOCK, INGESTED_CLOCK))


def touched_keys(staged: DataFrame, entity: Entity, marks: Marks) -> DataFrame:
    """Keys with a live row past either mark."""
    past = live_rows(staged).where(marks.passed_by(UPDATED_AT, EXTRACTED_AT))
    return past.selectExpr(quoted(entity.key)).distinct()


def incremental_rows(
    staged: DataFrame, entity: Entity, marks: Marks, touched: DataFrame | None = None
) -> DataFrame:
    """Current rows that changed since ``marks``.

    Without ``touched`` the whole log is ranked. With it, the result of ``touched_keys``, only the full
    history of those keys is. Every row past a mark names its key, so both give the same rows; filtering
    the log itself would not, as an older version with a later clock could win.

    Store the touched keys before they are used here: the planner then knows how few they are, and
    filters the log in the scan tasks instead of shuffling all of it for the join.
    """
    log = staged if touched is None else keep_keys(live_rows(staged), touched, entity.key)
    return past_high_water_mark(project_current(latest_by_key(log, entity.key), entity), marks)


def keep_keys(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among ``keys``. Null keys match each other, as they do when ranking."""
    wanted = keys.selectExpr(f"{quoted(key)} as __wanted")
    return rows.join(wanted, F.expr(f"{quoted(key)} <=> __wanted"), "left_semi")
