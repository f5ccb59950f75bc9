"""A small record beside a target that says which publish is under way.

It is written before files of the target are touched, by a rename, so it is there in full or not at all, and
removed after the last file is in place. Whoever finds one knows that the target may be half old, half new.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def begin(spark: SparkSession, target: str, record: dict) -> None:
    """Leave the record of a publish that is about to start.

    Only a full write may take the place of another record: it writes every row anew.
    """
    if not record.get("full") and pending(spark, target) is not None:
        raise RuntimeError(f"a publish of {target} has not ended")
    files, folder = _files(spark, target)
    draft, name = _path(spark, f"{folder}/pending.draft"), _path(spark, f"{folder}/pending.json")
    stream = files.create(draft, True)
    stream.write(bytearray(json.dumps(record).encode()))
    stream.close()
    files.delete(name, False)
    if not files.rename(draft, name):
        raise OSError(f"the record of {target} cannot be written")


def pending(spark: SparkSession, target: str) -> dict | None:
    """The record of a publish that has not ended, if there is one."""
    files, folder = _files(spark, target)
    name = _path(spark, f"{folder}/pending.json")
    if not files.exists(name):
        return None
    return json.loads(spark.read.text(f"{folder}/pending.json", wholetext=True).first()[0])


def end(spark: SparkSession, target: str) -> None:
    """The publish is complete."""
    files, folder = _files(spark, target)
    files.delete(_path(spark, folder), True)


def _path(spark: SparkSession, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(name)


def _files(spark: SparkSession, target: str):
    folder = f"{target.rstrip('/')}.journal"
    return _path(spark, folder).getFileSystem(spark._jsc.hadoopConfiguration()), folder
