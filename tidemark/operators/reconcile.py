"""Finding the rows in which a loaded table differs from its log, without comparing all of them.

High-water marks never pick up a row at or below both of them, so a fact can lack versions that its log has. Both
sides are reduced to a digest of 64 bits for each key, stored by key bucket. Counts and sums of the digests are
compared bucket by bucket; only the buckets that differ are read again, key by key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import column
from tidemark.sources.parquet import read_parquet

MISSING = "missing"
STALE = "stale"
EXTRA = "extra"
BUCKETS = 64


def store_digests(df: DataFrame, key: str, columns: Sequence[str], folder: str, buckets: int = BUCKETS) -> DataFrame:
    """(``key``, ``digest``, ``bucket``) of every row, one folder for each bucket."""
    bucket = F.pmod(F.xxhash64(column(key), F.lit("bucket")), F.lit(buckets)).cast("int").alias("bucket")
    digests = df.select(column(key).alias("key"), F.xxhash64(*[column(c) for c in columns]).alias("digest"), bucket)
    digests.hint("rebalance", F.col("bucket")).write.partitionBy("bucket").mode("overwrite").parquet(folder)
    return read_parquet(df.sparkSession, folder, schema=digests.schema)


def differing_buckets(expected: DataFrame, actual: DataFrame) -> list[int]:
    """Buckets whose digests do not add up to the same; at most all buckets, which are few."""
    sums = [F.count("*").alias("n"), F.sum(F.col("digest").cast("decimal(38,0)")).alias("total")]
    left = expected.groupBy("bucket").agg(*sums)
    right = actual.groupBy("bucket").agg(*sums).withColumnsRenamed({"n": "m", "total": "other"})
    found = left.join(right, "bucket", "full").where("not (n <=> m and total <=> other)").select("bucket").collect()
    return sorted(r[0] for r in found)


def reconcile(expected: DataFrame, actual: DataFrame, key: str, columns: Sequence[str], folder: str, buckets: int = BUCKETS) -> DataFrame:
    """(``key``, ``status``) of the keys that ``actual`` lacks, has in another form, or has in excess of ``expected``.

    Keys are unique on both sides, a null key counts as one. ``folder`` takes the digests, which may be deleted once
    the result is stored.
    """
    sides = [store_digests(df, key, columns, f"{folder}/{name}", buckets) for name, df in (("expected", expected), ("actual", actual))]
    differing = F.col("bucket").isin(differing_buckets(*sides))
    left, right = (df.where(differing).select("key", "digest").withColumnsRenamed({"key": k, "digest": d}) for df, k, d in zip(sides, "ab", ("x", "y"), strict=True))
    both = left.withColumn("of_a", F.lit(1)).join(right.withColumn("of_b", F.lit(1)), F.col("a").eqNullSafe(F.col("b")), "full")
    status = F.when(F.col("of_b").isNull(), MISSING).when(F.col("of_a").isNull(), EXTRA).when(~F.col("x").eqNullSafe(F.col("y")), STALE)
    return both.select(F.when(F.col("of_a").isNull(), F.col("b")).otherwise(F.col("a")).alias(key), status.alias("status")).where("status is not null")
