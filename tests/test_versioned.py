"""Versioned tables: what readers see, what is read to write, and what is left by a run that dies."""

import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.plans import marts
from tidemark.schemas import AUDIT
from tidemark.sinks import journal, upsert, versioned
from tidemark.sinks.versioned import VersionedTable, layout, ledger_frame, read_published, table_at

D1, D2, D3 = (datetime.date(2024, 1, d) for d in (1, 2, 3))


def facts(spark, *lines):
    return spark.createDataFrame(list(lines), "k bigint, day date, v string")


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "t"), "k", "day", ["v"])


def stored(table):
    return rows(table.read())


def test_replace_and_upsert(spark, table):
    assert table.head() is None
    assert table.replace(facts(spark, (1, D1, "a"), (2, D2, "b"), (3, None, "c"))).rows == 3
    assert table.upsert(facts(spark, (1, D3, "A"), (4, None, "d"))).rows == 2  # a row moves to another day
    assert stored(table) == [(1, D3, "A"), (2, D2, "b"), (3, None, "c"), (4, None, "d")]
    assert rows(table.read([D2, None])) == [(2, D2, "b"), (3, None, "c"), (4, None, "d")]
    assert table.read([D1]).count() == 0
    assert table.upsert(facts(spark)).rows == 0 and table.head().number == 2
    assert table.replace(facts(spark)).rows == 0 and stored(table) == []
    assert rows(read_published(spark, table.path)) == [] and table_at(spark, table.path).key == "k"


def test_null_keys_replace_nothing(spark, table):
    table.replace(facts(spark, (None, D1, "a"), (1, D1, "b")))
    table.upsert(facts(spark, (None, D1, "c")))
    assert stored(table) == [(None, D1, "a"), (None, D1, "c"), (1, D1, "b")]


def test_a_reader_keeps_its_version_during_a_publish(spark, table, monkeypatch):
    table.replace(facts(spark, (1, D1, "a"), (2, D2, "b")))
    before, seen = table.read(), []
    publish = VersionedTable._publish

    def watched(self, *args):
        seen.append((rows(before), stored(self)))  # all new files are written, none is published
        found = publish(self, *args)
        seen.append((rows(before), stored(self)))
        return found

    monkeypatch.setattr(VersionedTable, "_publish", watched)
    table.upsert(facts(spark, (1, D1, "A"), (2, D3, "B")))
    old, new = [(1, D1, "a"), (2, D2, "b")], [(1, D1, "A"), (2, D3, "B")]
    assert seen == [(old, old), (old, new)]


@pytest.mark.parametrize("step", ["_write", "_index", "_publish", "_rename"])
@pytest.mark.parametrize("change", ["replace", "upsert"])
def test_a_run_that_dies_changes_nothing(spark, table, monkeypatch, step, change):
    table.replace(facts(spark, (1, D1, "a"), (2, D2, "b")))

    def dies(self, *args):
        raise OSError("cut off")

    with monkeypatch.context() as cut, pytest.raises(OSError):
        cut.setattr(VersionedTable, step, dies)
        getattr(table, change)(facts(spark, (1, D1, "A"), (3, D3, "c")))
    assert stored(table) == [(1, D1, "a"), (2, D2, "b")]
    table.upsert(facts(spark, (2, D2, "B")))
    assert stored(table) == [(1, D1, "a"), (2, D2, "B")]
    named = {f.path.split("/")[1] for n in (1, 2) for f in table.version(n).files}
    assert set(table._names("files")) == named == set(table._names("index"))  # what was left has gone


def test_two_writers_cannot_publish_one_number(spark, table):
    table.replace(facts(spark, (1, D1, "a")))
    head = table.head()
    line = head.ledger[0]
    table._publish(head, None, head.struct, head.files, line, {})
    with pytest.raises(FileExistsError):
        table._publish(head, None, head.struct, (), line, {})
    assert stored(table) == [(1, D1, "a")]


def test_an_upsert_reads_only_files_that_may_hold_its_keys(spark, settings, tmp_path):
    settings(spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB", spark__sql__adaptive__coalescePartitions__minPartitionSize="1KB", spark__sql__shuffle__partitions="64")
    table = VersionedTable(spark, str(tmp_path / "t"), "k", "day")
    day = "date_add(date'2023-01-01', cast(id % 40 as int)) as day"
    table.replace(spark.range(0, 40_000, 1, 4).selectExpr("(id * 7919) % 1000003 as k", day, "uuid() as v"))
    head = table.head()
    assert len(head.files) > 20
    keys = table.read().orderBy("k").limit(10).select("k")
    changed = keys.selectExpr("k", "date'2023-01-05' as day", "'new' as v")
    holding = table.read().select("k", F.col("_metadata.file_name").alias("name")).join(keys, "k", "left_semi").select("name").distinct().count()
    likely = table.may_hold(head, keys)
    assert holding <= len(likely) <= holding + 3
    result = table.upsert(changed)
    assert len(result.rewritten) == holding
    stay = {f.path for f in table.head().files} & {f.path for f in head.files}
    assert len(stay) == len(head.files) - holding
    assert table.read().count() == 40_000 and table.read().where("v = 'new'").count() == 10
    # unknown keys are ruled out by the index: no old file is read
    assert table.upsert(spark.range(5).selectExpr("id + 2000000 as k", "date'2023-01-05' as day", "'more' as v")).rewritten == ()


def test_as_many_keys_as_files_have_rows_are_not_looked_up_for_each_file(spark, settings, tmp_path, monkeypatch):
    settings(spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB", spark__sql__adaptive__coalescePartitions__minPartitionSize="1KB", spark__sql__shuffle__partitions="64")
    table = VersionedTable(spark, str(tmp_path / "t"), "k", "day")
    table.replace(spark.range(0, 20_000, 1, 4).selectExpr("(id * 7919) % 1000003 as k", "date_add(date'2023-01-01', cast(id % 40 as int)) as day", "uuid() as v"))
    head = table.head()
    changed = table.read([datetime.date(2023, 1, 3)]).select("k", "day", F.lit("new").alias("v"))
    added = spark.range(10_000).selectExpr("id * 100 + 1000003 * (id % 2) as k", "date'2023-01-03' as day", "'added' as v")
    delta = changed.unionByName(added.join(table.read(), "k", "left_anti"))
    holding = table.read().select("k", F.col("_metadata.file_name").alias("name")).join(delta, "k", "left_semi").select("name").distinct().count()
    asked = []
    monkeypatch.setattr(versioned, "read_parquet", lambda spark, *paths, read=versioned.read_parquet, **options: asked.extend(paths) or read(spark, *paths, **options))
    keys = delta.select("k")
    assert set(table.may_hold(head, keys)) == set(head.files) and rows(table.rows_of(keys)) == rows(table.read().join(keys, "k", "left_semi"))
    assert len(table.upsert(delta).rewritten) == holding < len(head.files) / 2
    assert not [p for p in asked if f"{table.path}/index" in p]
    assert table.read().where("v = 'new'").count() == 500 and table.read().count() == 20_000 + delta.where("v = 'added'").count()


def test_days_open_their_files_only(spark, settings, tmp_path):
    settings(spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB", spark__sql__adaptive__coalescePartitions__minPartitionSize="1KB", spark__sql__shuffle__partitions="64")
    table = VersionedTable(spark, str(tmp_path / "t"), "k", "day")
    table.replace(spark.range(0, 20_000, 1, 4).selectExpr("id as k", "date_add(date'2023-01-01', cast(id % 40 as int)) as day", "uuid() as v"))
    some = table.read([datetime.date(2023, 1, 3)])
    assert some.count() == 500 and len(some.inputFiles()) < len(table.read().inputFiles()) / 5
    depth = layout(table, "k").agg(F.max("depth")).first()[0]
    assert depth >= 1


def test_layout_depth_counts_overlapping_ranges(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), "k", "day")
    table.replace(facts(spark, (1, D1, "a"), (2, D1, "f")))
    table.upsert(facts(spark, (3, D1, "c"), (4, D1, "d")))  # a second file of the day, inside the range of the first
    assert [(r.files, r.depth) for r in layout(table, "v").collect()] == [(2, 2.0)]
    other = VersionedTable(spark, str(tmp_path / "u"), "k", "day")
    other.replace(facts(spark, (1, D1, "a"), (2, D1, "b")))
    other.upsert(facts(spark, (3, D1, "c"), (4, D1, "d")))
    assert [(r.files, r.depth) for r in layout(other, "v").collect()] == [(2, 1.0)]


def test_a_repeated_load_leaves_one_line(spark, table):
    table.replace(facts(spark, (1, D1, "a")), "monday")
    assert not table.upsert(facts(spark, (2, D2, "b")), "tuesday").repeated
    again = table.upsert(facts(spark, (2, D2, "other")), "tuesday")
    assert again.repeated and stored(table) == [(1, D1, "a"), (2, D2, "b")]
    assert table.replace(facts(spark), "monday").repeated
    table.upsert(facts(spark), "wednesday")
    lines = rows(ledger_frame(spark, table.path).select("load_number", "load", "kind", "rows_in", "rows"))
    assert lines == [(1, "monday", "full", 1, 1), (2, "tuesday", "upsert", 1, 2), (3, "wednesday", "upsert", 0, 2)]


def test_a_failed_dimension_leaves_the_old_one(spark, tmp_path):
    path = str(tmp_path / "dim")
    marts.load_dimension(spark.range(3), path)
    broken = spark.range(5).select(F.when(F.col("id") < 4, F.col("id")).otherwise(F.raise_error("bad row").cast("bigint")).alias("id"))
    with pytest.raises(Exception, match="bad row"):
        marts.load_dimension(broken, path)
    assert marts.read_mart(spark, path).count() == 3
    marts.load_dimension(marts.read_mart(spark, path).where("id > 0"), path)  # from itself, without a copy
    assert rows(marts.read_mart(spark, path)) == [(1,), (2,)]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_clocks_are_those_of_the_table(spark, tmp_path, kind):
    table = VersionedTable(spark, str(tmp_path / "t"), "k", None, (), ("c",))
    values = ["2024-01-01 00:00:00.5", "2024-01-01 00:00:00", None]
    for i, value in enumerate(values):
        frame = spark.createDataFrame([(i, value)], "k bigint, c string").withColumn("c", F.col("c").cast(kind))
        table.upsert(frame) if i else table.replace(frame)
    clock = versioned.clock_value(table.head(), "c")
    assert spark.range(1).select(clock.alias("c")).first().c == table.read().agg(F.max("c")).first()[0]


def cut_off(spark, path, monkeypatch):
    """A full write of 100 rows on 10 days that dies after half of the days."""
    whole = upsert.write_partitioned
    source = spark.range(100).selectExpr("id as k", "date_add(date'2024-01-01', cast(id % 10 as int)) as day", "'a' as v")

    def half(df, *args, **kwargs):
        whole(df.where(F.dayofmonth("day") <= 5), *args, **kwargs)
        raise OSError("cut off")

    with monkeypatch.context() as cut, pytest.raises(OSError):
        cut.setattr(upsert, "write_partitioned", half)
        upsert.write_in_full(source, path, "day")
    return source


def test_no_upsert_into_a_full_write_that_was_cut_off(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    source = cut_off(spark, path, monkeypatch)
    with pytest.raises(RuntimeError, match="cut off"):
        upsert.upsert_partitions(spark, path, facts(spark, (1000, D1, "x")), "k", "day")
    assert journal.pending(spark, path) == {"full": True}
    with pytest.raises(RuntimeError, match="has not ended"):
        journal.begin(spark, path, {"days": []})
    upsert.write_in_full(source, path, "day")
    assert upsert.upsert_partitions(spark, path, facts(spark, (1000, D1, "x")), "k", "day").rows == 1
    assert spark.read.parquet(path).count() == 101


def test_a_load_makes_a_full_write_that_was_cut_off_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "fct")
    change = (
        "'1' as _ab_cdc_lsn", "cast(null as timestamp) as _ab_cdc_deleted_at", "timestamp'2024-01-01' as _ab_cdc_updated_at",
        "cast(id as string) as _airbyte_raw_id", "timestamp'2024-01-01' as _airbyte_extracted_at",
    )
    staged = spark.range(100).selectExpr("id as log_id", "'a' as action", "'b' as performed_by", "id as transaction_id", "timestamp_seconds(1704067200 + 86400 * (id % 10)) as event_timestamp", *change)
    whole = upsert.write_partitioned

    def half(df, *args, **kwargs):
        whole(df.where(F.dayofmonth("event_date") <= 5), *args, **kwargs)
        raise OSError("cut off")

    with monkeypatch.context() as cut, pytest.raises(OSError):
        cut.setattr(upsert, "write_partitioned", half)
        upsert.write_in_full(marts.fct_audit(staged), path, marts.AUDIT_DAY)
    for _ in range(2):
        marts.load_incremental(spark, path, staged, AUDIT, marts.audit_facts, marts.AUDIT_DAY)
        assert marts.read_mart(spark, path).count() == 100
