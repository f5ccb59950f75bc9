"""Setting aside rows whose text cannot be cast, instead of failing the load, and releasing them once corrected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import column, is_lossy, text
from tidemark.operators.staging import cast_of, stage
from tidemark.schemas import RAW_ID, Entity

REASON = "quarantine_reason"


def split_malformed(raw: DataFrame, entity: Entity, timestamp_type: str = "timestamp") -> tuple[DataFrame, DataFrame]:
    """Staged good rows, and bad raw rows with the names of the columns that cannot be cast."""
    casts = {c.raw: cast_of(c.cast, timestamp_type) for c in entity.columns if c.cast}
    lossy = {name: is_lossy(name, kind) for name, kind in casts.items()}
    broken = " or ".join(lossy.values())
    reasons = ", ".join(f"case when {test} then {text(name)} end" for name, test in lossy.items())
    good = stage(raw.where(f"not ({broken})"), entity, timestamp_type)
    return good, raw.where(broken).selectExpr("*", f"concat_ws(',', {reasons}) as {REASON}")


def release(
    quarantined: DataFrame, corrections: DataFrame, accepted: DataFrame, entity: Entity, order: str, timestamp_type: str = "timestamp"
) -> tuple[DataFrame, DataFrame]:
    """Staged rows that corrections make good, and quarantined rows that stay, with the reason that is left.

    ``corrections`` has the raw id, ``order`` and the raw columns that are mended; the greatest ``order`` of a raw id
    counts, and a null in it leaves the column as it was. Of one order the greatest values count. Raw ids that
    ``accepted`` holds are neither released again nor kept, so a replay adds nothing. A row without a raw id is never
    corrected and stays.
    """
    mended = [c for c in corrections.columns if c not in (RAW_ID, order)]
    values = F.struct(column(order), *[column(c) for c in mended])
    latest = corrections.where(column(RAW_ID).isNotNull()).groupBy(RAW_ID).agg(F.max(values).alias("_mended"))
    waiting = quarantined.drop(REASON).join(accepted.select(RAW_ID), RAW_ID, "left_anti")
    fixed = waiting.join(latest, RAW_ID, "left").withColumns(
        {c: F.coalesce(F.col("_mended").getField(c), column(c)) for c in mended}
    )
    return split_malformed(fixed.select(*[column(c) for c in quarantined.columns if c != REASON]), entity, timestamp_type)
