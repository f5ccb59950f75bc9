"""Built-in-only expressions; none of them leaves the JVM.

Wide projections are given to Spark as SQL text: one call per column instead of one per operation, which
keeps the time to build a plan short.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, DecimalType, FractionalType, NumericType, StringType, TimestampNTZType

SECONDS_PER_DAY = 86400


def quoted(name: str) -> str:
    """A name as SQL text, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def text(value: str) -> str:
    """A string literal as SQL text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def report_rows(rows: Iterable[Mapping[str, str]]) -> str:
    """A generator of constant-size reports: each mapping of column name to SQL text becomes a row."""
    structs = ["struct(" + ", ".join(f"{value} as {name}" for name, value in row.items()) + ")" for row in rows]
    return f"inline(array({', '.join(structs)}))"


def column(name: str) -> Column:
    """Column by its exact name."""
    return F.col(quoted(name))


def typed_null(data_type: DataType | str) -> Column:
    return F.lit(None).cast(data_type)


def utc_date(df: DataFrame, name: str) -> str:
    """UTC calendar day of a timestamp column, independent of the session time zone."""
    if isinstance(df.schema[name].dataType, TimestampNTZType):
        return f"to_date({quoted(name)})"
    return f"date_from_unix_date(cast(floor(unix_seconds({quoted(name)}) / {SECONDS_PER_DAY}) as int))"


def spread_nulls(keys: Sequence[str], by: Sequence[str]) -> str:
    """0 for a complete key, a hash of ``by`` when a key part is null.

    A null key matches nothing, yet an outer join still ships all null-key rows to one task. Joining on
    this expression as well sends them to many tasks and changes no match. The zero is a remainder by one
    because a literal would be folded into a plain filter, which no longer partitions.
    """
    incomplete = " or ".join(f"{quoted(k)} is null" for k in keys)
    zero = f"xxhash64({', '.join(map(quoted, keys))}) % 1"
    return f"case when {incomplete} then xxhash64({', '.join(map(quoted, by))}) else {zero} end"


def is_lossy(name: str, target: DataType | str) -> str:
    """True where a value is present but cannot be converted to ``target``."""
    target_name = target if isinstance(target, str) else target.simpleString()
    return f"({quoted(name)} is not null and try_cast({quoted(name)} as {target_name}) is null)"


def loses_value(name: str, source: DataType, target: DataType) -> str:
    """True where a value cannot be converted to ``target``, or comes back changed from it.

    Text has many spellings of one value, so it is judged by what it says: digits behind the target's
    scale, or a time of day where only the date stays.
    """
    value, kind = quoted(name), target.simpleString()
    changed = "false"
    if not isinstance(source, StringType):
        changed = f"not (try_cast(try_cast({value} as {kind}) as {source.simpleString()}) <=> {value})"
    elif isinstance(target, DateType):
        clock = f"try_cast({value} as timestamp_ntz)"
        changed = f"coalesce({clock} <> cast(try_cast({value} as date) as timestamp_ntz), false)"
    elif isinstance(target, NumericType) and not (isinstance(target, FractionalType) and not isinstance(target, DecimalType)):
        scale = target.scale if isinstance(target, DecimalType) else 0
        digits = f"length(trim(trailing '0' from regexp_extract({value}, '[.]([0-9]*)', 1)))"
        rounded = f"coalesce(try_cast(try_cast({value} as {kind}) as double) <> try_cast({value} as double), false)"
        changed = f"case when {value} rlike '[eE]' then {rounded} else {digits} > {scale} end"
    return f"({is_lossy(name, target)} or ({value} is not null and {changed}))"


def past_marks(updated_mark: Column, ingested_mark: Column, updated: str, ingested: str) -> Column:
    """Strictly past either high-water mark; a null mark lets nothing through."""
    return (column(updated) > updated_mark) | (column(ingested) > ingested_mark)


def same_name(spark: SparkSession) -> Callable[[str], str]:
    """Fold names the way the session resolves them."""
    case_sensitive = spark.conf.get("spark.sql.caseSensitive") == "true"
    return (lambda name: name) if case_sensitive else str.lower
