import pytest
from conftest import rows
from pyspark.sql.types import DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, StringType, TimestampType

from tidemark.sources import Sources, probe_path, probe_table, read_delivery, read_generations, read_parquet, widen
from tidemark.workspace import new_run, shared_folder


def write(spark, path, schema, *lines):
    spark.createDataFrame(list(lines), schema).write.parquet(str(path))
    return str(path)


def test_merge_schema(spark, tmp_path):
    write(spark, tmp_path / "d=1", "a int", (1,))
    write(spark, tmp_path / "d=2", "a int, c string", (2, "x"))
    found = read_parquet(spark, str(tmp_path), merge_schema=True).select("a", "c")
    assert rows(found) == [(1, None), (2, "x")]


def test_conflicting_types_are_refused_by_merge_and_read_as_generations(spark, tmp_path):
    paths = [write(spark, tmp_path / "1", "b int, s int", (1, 5)), write(spark, tmp_path / "2", "b bigint, s string", (2, "x"))]
    with pytest.raises(Exception, match="MERGE"):
        read_parquet(spark, *paths, merge_schema=True).collect()
    found = read_generations(spark, paths)
    assert [f.dataType.simpleString() for f in found.schema] == ["bigint", "string"]
    assert rows(found) == [(1, "5"), (2, "x")]


def test_a_delivery_of_conflicting_files_has_one_scan_for_each_schema(spark, tmp_path):
    folder = tmp_path / "in put"
    for day in range(4):
        write(spark, folder / f"day={day}", "b int, s string" if day % 2 else "b bigint", *([(day, "x")] if day % 2 else [(day,)]))
    found = read_delivery(spark, str(folder))
    assert rows(found.select("b", "s", "day")) == [(0, None, 0), (1, "x", 1), (2, None, 2), (3, "x", 3)]
    assert found.schema["b"].dataType == LongType()
    assert found._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 2


def test_declared_schema_widens_and_fills(spark, tmp_path):
    paths = [write(spark, tmp_path / "1", "b int", (1,)), write(spark, tmp_path / "2", "b bigint, c string", (2, "x"))]
    assert rows(read_parquet(spark, *paths, schema="b bigint, c string")) == [(1, None), (2, "x")]


@pytest.mark.parametrize(
    "left, right, common",
    [
        (IntegerType(), LongType(), LongType()),
        (FloatType(), DoubleType(), DoubleType()),
        (IntegerType(), DoubleType(), DoubleType()),
        (LongType(), DoubleType(), StringType()),
        (LongType(), DecimalType(38, 9), DecimalType(38, 9)),
        (DecimalType(10, 2), DecimalType(8, 4), DecimalType(12, 4)),
        (DateType(), TimestampType(), TimestampType()),
        (IntegerType(), StringType(), StringType()),
    ],
)
def test_widen(left, right, common):
    assert widen(left, right) == common and widen(right, left) == common


def test_probes(spark, tmp_path):
    path = write(spark, tmp_path / "t", "a int", (1,))
    found = probe_path(spark, path)
    assert found.columns == ["a"] and found.isEmpty()
    assert probe_path(spark, str(tmp_path / "none")) is None
    with pytest.raises(Exception, match="no_such_format"):
        probe_path(spark, path, fmt="no_such_format")
    assert probe_table(spark, "no_such_table") is None
    spark.createDataFrame([(1,)], "a int").write.mode("overwrite").saveAsTable("probed")
    assert probe_table(spark, "probed").columns == ["a"] and probe_table(spark, "probed").isEmpty()


def test_registry(spark):
    sources = Sources({"users": spark.range(3)})
    assert sources.views("raw_") == ["raw_users"]
    assert spark.sql("select count(*) from raw_users").first()[0] == 3
    with pytest.raises(KeyError, match="users"):
        sources["accounts"]


def test_workspace(spark, settings):
    assert new_run(spark, "x") != new_run(spark, "x")
    assert new_run(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


class Session:
    """A session with some settings."""

    def __init__(self, **settings):
        self.conf = {key.replace("__", "."): value for key, value in settings.items()}


def test_runs_lie_in_the_shared_folder_or_the_warehouse():
    assert shared_folder(Session(spark__checkpoint__dir="hdfs:/shared/")) == "hdfs:/shared"
    assert shared_folder(Session(spark__sql__warehouse__dir="s3a://lake/tables")) == "s3a://lake/tables/_runs"
