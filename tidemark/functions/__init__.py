"""Column expressions shared by the operators."""

from tidemark.functions.expressions import (
    column,
    is_lossy,
    loses_value,
    past_marks,
    quoted,
    report_rows,
    same_name,
    spread_nulls,
    text,
    typed_null,
    utc_date,
)

__all__ = [
    "column",
    "is_lossy",
    "loses_value",
    "past_marks",
    "quoted",
    "report_rows",
    "same_name",
    "spread_nulls",
    "text",
    "typed_null",
    "utc_date",
]
