import contextlib
import io
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .config("spark.checkpoint.dir", str(folder / "shared"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Set options for one test."""
    before = {}

    def change(**pairs):
        for key, value in pairs.items():
            key = key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def rows(df, *order):
    """Rows as plain tuples, sorted."""
    return sorted((tuple(row) for row in df.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))


def explained(df):
    """The formatted plan; after an action on ``df``, the one adaptive execution ended with."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def final_plan(df):
    """The plan as executed."""
    df.collect()
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue().split("Initial Plan")[0]
