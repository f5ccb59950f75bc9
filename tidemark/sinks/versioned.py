"""Tables whose files never change, published by one small manifest that is put in place by a rename.

    <table>/files/<run>/part-*.parquet      rows; a run's folder is written once, before it is published
    <table>/index/<run>/part-*.parquet      a Bloom filter of the keys of each of these files
    <table>/manifests/<number>.json         the files that make up a version, their days and key ranges, the
                                            newest clocks, the schema and the ledger of all loads

A version is the manifest with the highest number. It is written aside and renamed, and the rename does not
replace a file: a reader sees the old version or the new one, and of two writers with the same number one fails.
A run that dies before the rename leaves files that no manifest names, so nothing has to be finished or undone;
the next publish removes them. The version before the last one stays, for readers that still hold its files.

Days are whole within a file as far as size allows: a rebalance by day brings a day's rows together, and splits a
day too large for one task. The manifest lists the days of each file, so a read of some days opens their files
alone, and an upsert rewrites only the files that may hold one of its keys.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType, TimestampNTZType, TimestampType

from tidemark.functions import column
from tidemark.sinks.tables import arrange, overwrite_path, store
from tidemark.sources.parquet import read_parquet
from tidemark.workspace import new_run, remove_run

#: Bits of a filter for each key, bits a key sets, and bits of one stored bitmap (that of ``bitmap_construct_agg``).
BITS_PER_KEY = 12
HASHES = 4
BITMAP = 32_768


@dataclass(frozen=True)
class DataFile:
    """One immutable file: its days (``None`` for null), the range of its keys, and the bitmaps of its key filter."""

    path: str
    rows: int
    days: tuple[str | None, ...] = ()
    least_key: int | str | None = None
    greatest_key: int | str | None = None
    buckets: int = 0


@dataclass(frozen=True)
class LedgerLine:
    """What one load did. ``load`` is its caller's name for it, by which a repeated load is known."""

    load: str
    kind: str
    rows_in: int
    rows: int
    files_written: int
    files_dropped: int


@dataclass(frozen=True)
class Manifest:
    """One version of a table."""

    number: int
    schema: str
    key: str | None
    partition_by: str | None
    cluster_by: tuple[str, ...]
    files: tuple[DataFile, ...]
    clocks: dict[str, str | None] = field(default_factory=dict)
    ledger: tuple[LedgerLine, ...] = ()

    @property
    def rows(self) -> int:
        return sum(f.rows for f in self.files)

    @property
    def struct(self) -> StructType:
        return StructType.fromJson(json.loads(self.schema))

    def of_days(self, days: Iterable[date | None]) -> list[DataFile]:
        wanted = {d if d is None else d.isoformat() for d in days}
        return [f for f in self.files if wanted & set(f.days)]

    def text(self) -> str:
        return json.dumps(self, default=lambda x: x.__dict__)

    @classmethod
    def parse(cls, text: str) -> Manifest:
        raw = json.loads(text)
        files = tuple(DataFile(**(f | {"days": tuple(f["days"])})) for f in raw.pop("files"))
        ledger = tuple(LedgerLine(**line) for line in raw.pop("ledger"))
        return cls(**(raw | {"files": files, "ledger": ledger, "cluster_by": tuple(raw["cluster_by"])}))


@dataclass(frozen=True)
class Published:
    """The ledger line of a load, the files it read in full to rewrite them, and whether it had been made before."""

    line: LedgerLine
    rewritten: tuple[str, ...] = ()
    repeated: bool = False

    @property
    def rows(self) -> int:
        return self.line.rows_in


class VersionedTable:
    """A table at ``path``, optionally keyed, and laid out by a date column."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: str | None = None,
        partition_by: str | None = None,
        cluster_by: Sequence[str] = (),
        clocks: Sequence[str] = (),
    ):
        self.spark, self.path = spark, path.rstrip("/")
        self.key, self.partition_by, self.cluster_by, self.clocks = key, partition_by, tuple(cluster_by), tuple(clocks)

    # --- reading ---------------------------------------------------------------------------------------

    def head(self) -> Manifest | None:
        """The current version, or ``None`` if nothing has been published."""
        numbers = self._numbers()
        return self.version(max(numbers)) if numbers else None

    def version(self, number: int) -> Manifest:
        stream = self._files.open(self._at(f"manifests/{number:012d}.json"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Manifest.parse(text)

    def read(self, days: Iterable[date | None] | None = None, version: int | None = None) -> DataFrame:
        """The rows of the current version (or that of a number), of some ``days`` only if these are given."""
        manifest = self.head() if version is None else self.version(version)
        if manifest is None:
            raise FileNotFoundError(f"nothing has been published at {self.path}")
        if days is None:
            return self._scan(manifest.files, manifest.struct)
        days = list(days)
        rows = self._scan(manifest.of_days(days), manifest.struct)
        return rows.where(_one_of(manifest.partition_by, days))

    def _scan(self, files: Iterable[DataFile], schema: StructType) -> DataFrame:
        paths = [f"{self.path}/{f.path}" for f in files]
        return read_parquet(self.spark, *paths, schema=schema) if paths else self.spark.createDataFrame([], schema)

    # --- writing ---------------------------------------------------------------------------------------

    def replace(self, df: DataFrame, load: str | None = None) -> Published:
        """A full refresh: the new rows are written aside and take the old ones' place in one step."""
        before = self.head()
        if (again := self._made(before, load)) is not None:
            return again
        run, schema = self._new_run(), df.schema
        files = self._write(df, run, schema)
        rows = sum(f.rows for f in files)
        line = LedgerLine(load or run, "full", rows, rows, len(files), len(before.files) if before else 0)
        self._publish(before, run, schema, files, line, self._clocks_of(files, schema))
        return Published(line)

    def upsert(self, delta: DataFrame, load: str | None = None) -> Published:
        """Replace or add the rows of ``delta`` by the key; its keys must be unique, null keys replace nothing.

        Only files that may hold one of the keys are read in full: their key range and filter are asked first,
        and of the files left the key column alone tells which hold one. They are rewritten without these keys,
        together with the new rows; all other files stay as they are.
        """
        before = self.head()
        if before is None:
            raise FileNotFoundError(f"nothing has been published at {self.path}")
        if (again := self._made(before, load)) is not None:
            return again
        schema = before.struct
        work = new_run(self.spark, "upsert")
        shaped = delta.select(*[column(f.name).cast(f.dataType).alias(f.name) for f in schema])
        delta = store(shaped, f"{work}/delta")  # used several times below
        rows = delta.count()
        if not rows:
            remove_run(self.spark, work)
            line = LedgerLine(load or self._new_run(), "upsert", 0, before.rows, 0, 0)
            if load is not None:
                self._publish(before, None, schema, before.files, line, before.clocks)
            return Published(line)
        touched = self._holding(before, delta.select(column(self.key)).where(column(self.key).isNotNull()))
        kept = self._scan(touched, schema)
        kept = kept.join(delta.select(column(self.key)), self.key, "left_anti").select(*[column(c) for c in schema.names])
        run = self._new_run()
        written = self._write(kept.unionByName(delta), run, schema)
        stay = tuple(f for f in before.files if f not in set(touched))
        files = (*stay, *written)
        line = LedgerLine(load or run, "upsert", rows, sum(f.rows for f in files), len(written), len(touched))
        # A clock never goes back: what a row was replaced by is in the same increment.
        clocks = self._later(before.clocks, self._clocks_of(written, schema), schema)
        self._publish(before, run, schema, files, line, clocks)
        remove_run(self.spark, work)
        return Published(line, tuple(f.path for f in touched))

    def _holding(self, manifest: Manifest, keys: DataFrame) -> list[DataFile]:
        """Files with one of the keys: by range, then by filter, then by the key column of what is left."""
        likely = self.may_hold(manifest, keys)
        if not likely:
            return []
        by_name = {f.path.removeprefix("files/"): f for f in likely}
        stored = self._scan(likely, manifest.struct).select(column(self.key), _file_of().alias("__file"))
        found = stored.join(keys, self.key, "left_semi").select("__file").distinct().collect()  # names of files
        return [by_name[r[0]] for r in found]

    def rows_of(self, keys: DataFrame) -> DataFrame:
        """The stored rows with one of ``keys``; files that hold none of them are not opened."""
        manifest = self.head()
        if manifest is None:
            raise FileNotFoundError(f"nothing has been published at {self.path}")
        stored = self._scan(self.may_hold(manifest, keys), manifest.struct)
        return stored.join(keys, self.key, "left_semi").select(*[column(c) for c in manifest.struct.names])

    def may_hold(self, manifest: Manifest, keys: DataFrame) -> list[DataFile]:
        """Files that the index cannot rule out for any of the keys.

        Looking up each key for each file pays only as long as that is less than the files hold: filters rule nothing
        out for as many keys as a file has rows, so the work would grow with keys times files and gain nothing.
        """
        name = column(self.key)
        low, high, asked = keys.agg(F.min(name), F.max(name), F.count(name)).first()
        near = [f for f in manifest.files if low is not None and f.least_key is not None and not (f.greatest_key < low or f.least_key > high)]
        if not near or asked * len(near) >= sum(f.rows for f in near):
            return near
        runs = sorted({f.path.split("/")[1] for f in near})
        index = read_parquet(self.spark, *[f"{self.path}/index/{run}" for run in runs], schema=_INDEX)
        # Filters have as many bitmaps as their file needs; a key is looked up once for each such number.
        sizes = F.array(*[F.lit(n) for n in sorted({f.buckets for f in near})])
        asked = keys.select(name.alias("key"), F.explode(sizes).alias("buckets"))
        asked = asked.select("buckets", _bucket(F.col("key"), F.col("buckets")).alias("bucket"), *[_bit(F.col("key"), i).alias(f"bit{i}") for i in range(HASHES)])
        hit = " and ".join(f"(cast(conv(hex(substring(bits, bit{i} div 8 + 1, 1)), 16, 10) as int) & shiftleft(1, bit{i} % 8)) <> 0" for i in range(HASHES))
        found = index.join(asked.distinct(), ["buckets", "bucket"]).where(hit).select("file").distinct().collect()  # names of files
        names = {r[0] for r in found}
        return [f for f in near if f.path.removeprefix("files/") in names]

    def _write(self, df: DataFrame, run: str, schema: StructType) -> tuple[DataFile, ...]:
        """Files of one run, described and indexed. What describes them is taken from the written columns alone."""
        by = self.partition_by or self.key
        laid = df if by is None else arrange(df, by, self.cluster_by)
        overwrite_path(laid, f"{self.path}/files/{run}")
        written = read_parquet(self.spark, f"{self.path}/files/{run}", schema=schema)
        if self.partition_by is not None and not isinstance(schema[self.partition_by].dataType, DateType):
            raise TypeError(f"{self.partition_by} must be a date")
        facts = [F.count(F.lit(1)).alias("rows")]
        if self.partition_by is not None:
            facts.append(F.collect_set(F.coalesce(column(self.partition_by).cast("string"), F.lit(""))).alias("days"))
        if self.key is not None:
            facts += [F.min(column(self.key)).alias("least"), F.max(column(self.key)).alias("greatest")]
        lines = written.select("*", F.col("_metadata.file_name").alias("__name")).groupBy("__name").agg(*facts).collect()  # one for each file
        files = []
        for line in sorted(lines, key=lambda r: r["__name"]):
            row = line.asDict()
            days = tuple(sorted((d or None for d in row.get("days", ())), key=lambda d: d or ""))
            buckets = max(1, -(-row["rows"] * BITS_PER_KEY // BITMAP)) if self.key is not None else 0
            files.append(DataFile(f"files/{run}/{row['__name']}", row["rows"], days, row.get("least"), row.get("greatest"), 1 << (buckets - 1).bit_length() if buckets else 0))
        if self.key is not None and files:
            self._index(written, run, files)
        return tuple(files)

    def _index(self, written: DataFrame, run: str, files: Sequence[DataFile]) -> None:
        """A blocked Bloom filter of each file: a key's bits all lie in one of the file's bitmaps."""
        sizes = self.spark.createDataFrame([(f.path.rsplit("/", 1)[-1], f.buckets) for f in files], "__name string, buckets int")
        keyed = written.where(column(self.key).isNotNull()).select(column(self.key).alias("key"), F.col("_metadata.file_name").alias("__name"))
        placed = keyed.join(F.broadcast(sizes), "__name")  # one line for each file, which the driver has at hand
        spread = placed.select("__name", "buckets", _bucket(F.col("key"), F.col("buckets")).alias("bucket"), *[_bit(F.col("key"), i).alias(f"bit{i}") for i in range(HASHES)])
        # One bitmap for each hash first: keys are sorted once, not once for each of their bits.
        parts = spread.groupBy("__name", "buckets", "bucket").agg(F.array(*[F.bitmap_construct_agg(f"bit{i}") for i in range(HASHES)]).alias("parts"))
        filters = parts.select("__name", "buckets", "bucket", F.explode("parts").alias("part")).groupBy("__name", "buckets", "bucket").agg(F.bitmap_or_agg("part").alias("bits"))
        overwrite_path(filters.select(F.concat(F.lit(f"{run}/"), "__name").alias("file"), "buckets", "bucket", "bits"), f"{self.path}/index/{run}")

    # --- publishing ------------------------------------------------------------------------------------

    def _publish(self, before: Manifest | None, run: str | None, schema: StructType, files: Sequence[DataFile], line: LedgerLine, clocks: dict[str, str | None]) -> Manifest:
        number = before.number + 1 if before else 1
        ledger = (*(before.ledger if before else ()), line)
        manifest = Manifest(number, schema.json(), self.key, self.partition_by, self.cluster_by, tuple(files), clocks, ledger)
        draft = self._at(f"manifests/.{number:012d}.{uuid.uuid4().hex}")
        stream = self._files.create(draft, False)
        stream.write(bytearray(manifest.text().encode()))
        stream.close()
        self._rename(draft, self._at(f"manifests/{number:012d}.json"))
        self._clean(manifest, before)
        return manifest

    def _rename(self, draft, name) -> None:
        """Fails if ``name`` is there: another writer has published this number."""
        jvm = self.spark._jvm
        options = self.spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._at("").toUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(self._files.makeQualified(draft), self._files.makeQualified(name), options)
        except Exception as error:
            self._files.delete(draft, False)
            raise FileExistsError(f"{self.path} was published by another writer") from error

    def _clean(self, manifest: Manifest, before: Manifest | None) -> None:
        """Removes what neither this version nor the one before names: older versions, and runs that were cut off."""
        for number in self._numbers():
            if number < manifest.number - 1:
                self._files.delete(self._at(f"manifests/{number:012d}.json"), False)
        named = {f.path for m in (manifest, before) if m for f in m.files}
        runs = {path.split("/")[1] for path in named}
        for kind in ("files", "index"):
            for name in self._names(kind):
                if name not in runs:
                    self._files.delete(self._at(f"{kind}/{name}"), True)

    def _made(self, before: Manifest | None, load: str | None) -> Published | None:
        found = [line for line in (before.ledger if before else ()) if load is not None and line.load == load]
        return Published(found[0], repeated=True) if found else None

    # --- clocks ----------------------------------------------------------------------------------------

    def _clocks_of(self, files: Sequence[DataFile], schema: StructType) -> dict[str, str | None]:
        """The newest value of each clock in the files: microseconds of zoned ones, text of others."""
        if not self.clocks or not files:
            return dict.fromkeys(self.clocks)
        newest = self._scan(files, schema).agg(*[F.max(column(c)).alias(c) for c in self.clocks])
        return newest.select(*[_clock_text(column(c), schema[c].dataType).alias(c) for c in self.clocks]).first().asDict()

    def _later(self, left: dict[str, str | None], right: dict[str, str | None], schema: StructType) -> dict[str, str | None]:
        def later(c: str) -> str | None:
            both = [x for x in (left.get(c), right.get(c)) if x is not None]
            return max(both, key=int if isinstance(schema[c].dataType, TimestampType) else _padded, default=None)

        return {c: later(c) for c in self.clocks}

    # --- files -----------------------------------------------------------------------------------------

    @property
    def _files(self):
        return self._at("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _names(self, folder: str) -> list[str]:
        place = self._at(folder)
        return [s.getPath().getName() for s in self._files.listStatus(place)] if self._files.exists(place) else []

    def _numbers(self) -> list[int]:
        return [int(name[:12]) for name in self._names("manifests") if name.endswith(".json") and name[:12].isdigit()]

    @staticmethod
    def _new_run() -> str:
        return uuid.uuid4().hex


_INDEX = "file string, buckets int, bucket int, bits binary"


def _clock_text(value: Column, kind) -> Column:
    return F.unix_micros(value).cast("string") if isinstance(kind, TimestampType) else value.cast("string")


def _padded(text: str) -> str:
    """Timestamps as text sort as they follow each other once all have a fraction."""
    return text if "." in text else f"{text}."


def clock_value(manifest: Manifest, name: str) -> Column:
    """A manifest's clock as a literal of its type."""
    zoned = not isinstance(manifest.struct[name].dataType, TimestampNTZType)
    text = manifest.clocks.get(name)
    return F.timestamp_micros(F.lit(text).cast("bigint")) if zoned else F.lit(text).cast("timestamp_ntz")


def _one_of(name: str, days: Sequence[date | None]) -> Column:
    match = column(name).isin(*[day for day in days if day is not None])
    return match | column(name).isNull() if None in days else match


def _file_of() -> Column:
    return F.concat_ws("/", F.slice(F.split(F.col("_metadata.file_path"), "/"), -2, 2))


def _bucket(key: Column, buckets: Column) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("bucket")), buckets).cast("int")


def _bit(key: Column, place: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(place)), F.lit(BITMAP)).cast("int")


def table_at(spark: SparkSession, path: str) -> VersionedTable:
    """The published table at ``path``, with the key, layout and clocks it was published with."""
    table = VersionedTable(spark, path)
    manifest = table.head()
    if manifest is None:
        raise FileNotFoundError(f"nothing has been published at {path}")
    return VersionedTable(spark, path, manifest.key, manifest.partition_by, manifest.cluster_by, tuple(manifest.clocks))


def is_published(spark: SparkSession, path: str) -> bool:
    return VersionedTable(spark, path).head() is not None


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the current version."""
    return VersionedTable(spark, path).read()


def ledger_frame(spark: SparkSession, path: str) -> DataFrame:
    """All loads of a table, in order."""
    manifest = VersionedTable(spark, path).head()
    lines = [(i, x.load, x.kind, x.rows_in, x.rows, x.files_written, x.files_dropped) for i, x in enumerate(manifest.ledger if manifest else (), 1)]
    return spark.createDataFrame(lines, "load_number int, load string, kind string, rows_in bigint, rows bigint, files_written int, files_dropped int")


def layout(table: VersionedTable, value: str) -> DataFrame:
    """How far the files of a day overlap in ``value``: (day, files, depth), where depth is the mean number of the
    day's files that a file's range of values meets, itself included. A clustered layout comes near 1."""
    manifest = table.head()
    day = manifest.partition_by
    rows = table.read().select(column(day).alias("day"), column(value).alias("value"), F.col("_metadata.file_path").alias("file"))
    ranges = rows.groupBy("day", "file").agg(F.min("value").alias("least"), F.max("value").alias("greatest"))
    # Of the ranges of a day, those that end before one starts do not meet it; counting starts and ends in order
    # needs no pairs of files.
    starts = ranges.selectExpr("day", "least as at", "0 as ends")
    ends = ranges.selectExpr("day", "greatest as at", "1 as ends")
    over = f"partition by day order by at, ends rows between unbounded preceding and current row"
    swept = starts.unionByName(ends).selectExpr("day", "ends", f"sum(1 - ends) over ({over}) - sum(ends) over ({over}) as open")
    met = swept.where("ends = 0").groupBy("day").agg(F.count("*").alias("files"), F.sum("open").alias("met"))
    # Each meeting of two ranges is counted once, by the one that starts later; itself once.
    return met.select("day", F.col("files").cast("int").alias("files"), ((2 * F.col("met") - F.col("files")) / F.col("files")).alias("depth"))
