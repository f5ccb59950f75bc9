import pyarrow.parquet as pq
import pytest
from conftest import explained, rows

from tidemark.operators import marks as m
from tidemark.operators.marks import Marks, high_water_mark, touched_keys
from tidemark.schemas import Column, Entity
from tidemark.session import JOB_CONF

THING = Entity("things", "k", (Column("k", "k"), Column("v", "v")))


def staged(spark, lines, kind="timestamp"):
    """Lines are (key, lsn, updated, extracted) with clocks in days."""
    frame = spark.createDataFrame(lines, "k bigint, lsn int, upd int, ext int")
    day = f"cast({kind}'2024-01-01' + make_dt_interval({{}}) as {kind})"
    return frame.selectExpr(
        "k", "concat_ws('/', lsn, upd, ext) as v", "cast(lsn as decimal(38,9)) as _ab_cdc_lsn",
        f"cast(null as {kind}) as _ab_cdc_deleted_at", f"{day.format('upd')} as _ab_cdc_updated_at",
        f"{day.format('ext')} as _airbyte_extracted_at", "concat_ws('-', k, lsn) as _airbyte_raw_id",
    )


def target(spark, days, kind="timestamp"):
    day = f"cast({kind}'2024-01-01' + make_dt_interval(id) as {kind})"
    return spark.createDataFrame([(d,) for d in days], "id int").selectExpr(
        f"{day} as last_updated_at", f"{day} as ingested_at"
    )


def incremental_rows(log, entity, marks, touched_only=True):
    return m.incremental_rows(log, entity, marks, touched_keys(log, entity, marks) if touched_only else None)


LOG = [(1, 10, 3, 3), (1, 9, 2, 6), (2, 10, 6, 6), (2, 9, 2, 2), (3, 1, 1, 1), (4, 1, 1, 9), (4, 2, 7, 1)]


@pytest.mark.parametrize("touched_only", [True, False])
@pytest.mark.parametrize("make", [Marks.deferred, Marks.fetched])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_an_older_version_with_a_later_clock_does_not_win(spark, touched_only, make, kind):
    found = incremental_rows(staged(spark, LOG, kind), THING, make(target(spark, [5, 1], kind)), touched_only)
    assert rows(found.select("k", "v")) == [(2, "10/6/6"), (4, "2/7/1")]


@pytest.mark.parametrize("touched_only", [True, False])
def test_marks_are_strict_and_either_clock_counts(spark, touched_only):
    lines = [(1, 1, 5, 5), (2, 1, 6, 1), (3, 1, 1, 6), (4, 1, 5, 6)]
    found = incremental_rows(staged(spark, lines), THING, Marks.deferred(target(spark, [5])), touched_only)
    assert rows(found.select("k")) == [(2,), (3,), (4,)]


@pytest.mark.parametrize("make", [Marks.deferred, Marks.fetched])
def test_an_empty_target_lets_nothing_through(spark, make):
    empty = target(spark, [])
    assert rows(high_water_mark(empty)) == [(None, None)]
    assert incremental_rows(staged(spark, LOG), THING, make(empty)).isEmpty()


@pytest.mark.parametrize("touched_only", [True, False])
def test_null_keys_are_ranked_together(spark, touched_only):
    lines = [(None, 2, 1, 1), (None, 1, 9, 9), (1, 1, 9, 9)]
    found = incremental_rows(staged(spark, lines), THING, Marks.deferred(target(spark, [5])), touched_only)
    assert rows(found.select("k")) == [(1,)]
    lines = [(None, 2, 9, 1), (None, 1, 1, 9)]
    found = incremental_rows(staged(spark, lines), THING, Marks.deferred(target(spark, [5])), touched_only)
    assert rows(found.select("k", "v")) == [(None, "2/9/1")]


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_fetched_marks_do_not_depend_on_the_session_zone(spark, settings, zone):
    lines = [(i, 1, i, i) for i in range(10)]
    log, loaded = staged(spark, lines), target(spark, [5])
    settings(spark__sql__session__timeZone=zone)
    assert rows(incremental_rows(log, THING, Marks.fetched(loaded)).select("k")) == [(6,), (7,), (8,), (9,)]


def test_fetched_marks_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "log")
    staged(spark, LOG).write.parquet(path)
    found = incremental_rows(spark.read.parquet(path), THING, Marks.fetched(target(spark, [5])))
    plan = explained(found)
    assert "GreaterThan(_ab_cdc_updated_at" in plan and "GreaterThan(_airbyte_extracted_at" in plan


def test_zoned_clocks_of_jobs_have_statistics(spark, settings, tmp_path):
    """Written as jobs write them, a sorted log skips the row groups below a mark."""
    name = "spark.sql.parquet.outputTimestampType"
    settings(**{name.replace(".", "__"): JOB_CONF[name]})
    log = spark.range(0, 200_000, 1, 1).selectExpr("timestamp_seconds(id) as clock")
    log.write.option("parquet.block.size", 1 << 16).parquet(str(tmp_path / "log"))
    (file,) = (tmp_path / "log").glob("*.parquet")
    meta = pq.read_metadata(file)
    assert meta.num_row_groups > 1
    assert all(meta.row_group(i).column(0).statistics.has_min_max for i in range(meta.num_row_groups))
    late = spark.read.parquet(str(tmp_path / "log")).where("clock >= timestamp_seconds(199000)")
    assert late.count() == 1_000
    plan = late._jdf.queryExecution().executedPlan()
    late.collect()
    scan = plan.collectLeaves().apply(0)
    assert scan.metrics().apply("numOutputRows").value() < 200_000
