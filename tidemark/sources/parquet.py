"""Parquet scans under the three schema policies: single footer, merged, declared."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from tidemark.functions import column, same_name, typed_null

# Decimal digits that hold every value of an integer type.
INTEGER_DIGITS = {ByteType(): 3, ShortType(): 5, IntegerType(): 10, LongType(): 20}


def read_parquet(
    spark: SparkSession,
    *paths: str,
    schema: StructType | str | None = None,
    merge_schema: bool = False,
    base: str | None = None,
) -> DataFrame:
    """Scan parquet files or folders.

    Without options one footer gives the schema; ``merge_schema`` unites the footers, which Spark reads
    in a distributed job; ``schema`` is taken as declared. A declared schema is the cheapest on a folder
    of many files, and lets the reader widen integers and decimals file by file. ``base`` is the folder
    below which folder names count as partition columns, for paths that are single files.
    """
    reader = spark.read
    if base is not None:
        reader = reader.option("basePath", base)
    if schema is not None:
        reader = reader.schema(schema)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    return reader.parquet(*paths)


def read_delivery(spark: SparkSession, path: str) -> DataFrame:
    """All columns of all files below ``path``, also where a merge of their footers is refused.

    Files of conflicting schemas are told apart by halving the list of files until each part merges; parts
    of equal schema are scanned together, so the plan has one scan for each schema, not for each file.
    """
    whole = _merged(spark, path)
    if whole is not None:
        return whole
    # names only, which the driver holds for every scan anyway
    files = sorted(unquote(f) for f in read_parquet(spark, path).inputFiles())
    parts: dict[str, list[str]] = {}
    waiting = [files]
    while waiting:
        part = waiting.pop()
        frame = _merged(spark, *part, base=path)
        if frame is None:
            waiting += [part[len(part) // 2 :], part[: len(part) // 2]]
        else:
            parts.setdefault(frame.schema.json(), []).extend(part)
    return read_generations(spark, list(parts.values()), base=path)


def _merged(spark: SparkSession, *paths: str, base: str | None = None) -> DataFrame | None:
    """A scan under the merged schema, or ``None`` if several files do not merge."""
    try:
        return read_parquet(spark, *paths, merge_schema=True, base=base)
    except Py4JJavaError as error:
        if "CANNOT_MERGE_SCHEMA" in str(error.java_exception) and (base is None or len(paths) > 1):
            return None
        raise


def read_generations(
    spark: SparkSession, deliveries: Sequence[str | Sequence[str]], base: str | None = None
) -> DataFrame:
    """Scan deliveries whose schemas conflict, so that a footer merge would be refused.

    Each delivery is a path, or several, with a consistent schema. Columns are cast to the narrowest type
    that holds every delivery's values and missing ones become null. The result is one union of plain scans.
    """
    frames = [
        read_parquet(spark, *([paths] if isinstance(paths, str) else paths), merge_schema=True, base=base)
        for paths in deliveries
    ]
    fold = same_name(spark)
    names: dict[str, str] = {}
    types: dict[str, DataType] = {}
    for frame in frames:
        for field in frame.schema:
            key = fold(field.name)
            names.setdefault(key, field.name)
            types[key] = widen(types[key], field.dataType) if key in types else field.dataType

    def conform(frame: DataFrame) -> DataFrame:
        present = {fold(f.name): f.name for f in frame.schema}
        return frame.select(
            *[
                (column(present[key]).cast(types[key]) if key in present else typed_null(types[key])).alias(name)
                for key, name in names.items()
            ]
        )

    return reduce(DataFrame.union, [conform(frame) for frame in frames])


def widen(left: DataType, right: DataType) -> DataType:
    """Narrowest common type without loss; text when there is none."""
    if left == right:
        return left
    integers = list(INTEGER_DIGITS)
    if left in INTEGER_DIGITS and right in INTEGER_DIGITS:
        return max(left, right, key=integers.index)
    if {left, right} == {FloatType(), DoubleType()}:
        return DoubleType()
    if {left, right} == {DateType(), TimestampNTZType()}:
        return TimestampNTZType()
    if {left, right} == {DateType(), TimestampType()}:
        return TimestampType()
    small = {ByteType(), ShortType(), IntegerType()}
    if (left in small and right == DoubleType()) or (right in small and left == DoubleType()):
        return DoubleType()
    decimals = [_as_decimal(left), _as_decimal(right)]
    if None not in decimals:
        scale = max(d.scale for d in decimals)
        digits = max(d.precision - d.scale for d in decimals)
        if digits + scale <= 38:
            return DecimalType(digits + scale, scale)
    return StringType()


def _as_decimal(data_type: DataType) -> DecimalType | None:
    if isinstance(data_type, DecimalType):
        return data_type
    digits = INTEGER_DIGITS.get(data_type)
    return DecimalType(digits, 0) if digits else None


def probe_table(spark: SparkSession, table: str) -> DataFrame | None:
    """Zero-row frame with the table's schema, or ``None`` if there is no such table."""
    if not spark.catalog.tableExists(table):
        return None
    return spark.table(table).where("1 = 0")


def probe_path(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """Zero-row frame with the schema stored at ``path``, or ``None`` if nothing is there.

    Other failures, such as missing rights, are raised.
    """
    try:
        return spark.read.format(fmt).load(path).where("1 = 0")
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
