"""Session factory for the jobs. Library functions use whatever session they are given."""

from __future__ import annotations

from pyspark.sql import SparkSession

JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_LTZ",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "false",
    # Zoned timestamps with statistics, by which scans skip row groups below a mark.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app_name: str = "tidemark", **conf: str) -> SparkSession:
    """Session with UTC days and zoned timestamps; keyword pairs use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in JOB_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
