"""Exact Jaccard join of word n-gram sets in their metric space.

The Jaccard distance d = 1 - |x & y| / |x | y| is a metric, so pivots split the space. Two sets link at a distance
of ``reach`` or less (1 - threshold). Copies of a set are one set throughout.

Level 1, sampled pivots. The distances of every set to a bounded number of pivots, drawn by hash, are counted
through the pivots' shingles. A set at ``reach`` or less from a pivot belongs to the Voronoi region of its
nearest pivot and links to all such pivots. By the triangle inequality a partner of a region's member is at most
``2 * reach`` from the pivot: sets in that window are replicated to the region as guests, and a guest at distance
g meets only members in the window [g - reach, reach]. What the links made so far already tie to the pivot needs
no comparison. So a large group of near copies becomes a star, not pairs. The boundary is joined in the same way:
guests that no link ties to their region are drawn as pivots among the members they face, as long as that settles
half of them; the rest meets its members by shingles.

Next levels. What no pivot reached is a region of its own, all its pairs still open, and is split in the same
way by ``GROWTH`` times as many pivots, until every remaining set is a pivot; then a set's links to pivots are
all its links. Pivots that are too many for a task's memory are found through common rare shingles: of sets that
are near enough, the first shingles in one global order (hot ones last) must meet.

Within regions and on the last level pairs are candidates if enough of those first shingles are common, and all
are verified on whole sets; on the last level the owners of a shingle meet the least of them first, and sets that are
tied by then make no pairs. The result is exact: no pair within reach is left out unless both are tied already.

Shingles are 64-bit hashes of the words of a window, so set sizes and distances are exact up to collisions (one
in 10**13 for a pair of long texts). Hot shingles only decide an order; any order gives the same result.

Defined cases: a null, empty or wordless text has no shingles, is linked with nothing and has its own id as
component; a text shorter than the window has its whole word sequence as one shingle; copies of a row or text
are linked; ``component_id`` is the smallest id, null only where a component has no ids; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import column
from tidemark.llm.common import kept, small_batches, table, utf8
from tidemark.llm.components import components

WIDTH = 4
#: Least similarity of linked sets, in hundredths.
PERCENT = 85
#: Pivots of the first level, and the shingles they may hold together.
PIVOTS = 1_024
PIVOT_SHINGLES = 1 << 19
#: How many times more pivots each following level has.
GROWTH = 256
#: Shingles seen so often in one task's share come last in the global order; the list of them is bounded.
HOT = 8
HOT_SHINGLES = 1 << 20
#: Pairs must have one in so many of their shingles, and one more, in common among the first.
SOME = 50
#: Rows whose sets a task holds at a time, and bytes of text whose words it hashes at a time.
SLICE = 512
PIECE = 1 << 18

ORACLE = f"""
with words as (
  select rowid as row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w
  from (select row_number() over () as rowid, * from documents)
),
sets as (
  select row, doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < {WIDTH} then [array_to_string(w, ' ')]
    else [array_to_string(w[i:i + {WIDTH} - 1], ' ') for i in range(1, len(w) - {WIDTH} + 2)] end) as s from words
),
shingles as (select row, len(s) as n, unnest(s) as shingle from sets),
links as (
  select a.row as a, b.row as b from shingles a join shingles b on a.shingle = b.shingle
  where 100 * least(a.n, b.n) >= {PERCENT} * greatest(a.n, b.n)
  group by a.row, b.row, a.n, b.n having 100 * count(*) >= {PERCENT} * (a.n + b.n - count(*))
),
reached as (
  with recursive r(a, b) as (select row, row from sets union select r.a, l.b from r join links l on l.a = r.b) select * from r
)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, min(t.doc_id) as component_id
from sets s join reached r on r.a = s.row join sets t on t.row = r.b group by s.row, s.doc_id, s.s
"""

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint64) + 1
_LOWER[65:91] = np.arange(97, 123) + 1
_BASE = 0x9E3779B97F4A7C15
_MIX = [np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


# --- shingles ----------------------------------------------------------------------------------------


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, made as far as they are asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << max(n - 1, PIECE).bit_length()
            self.up, self.down = (self._of(b, size) for b in (_BASE, pow(_BASE, -1, 1 << 64)))
        return self.up[:n], self.down

    @staticmethod
    def _of(base: int, n: int) -> np.ndarray:
        found = np.full(n, base, np.uint64)
        found[0] = 1
        return np.multiply.accumulate(found)


_POWERS = _Powers()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row (place in ``starts``) and hash of every word of the rows that begin at ``starts``."""
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    held = starts[starts < len(data)]
    begins[held] = inside[held]
    at = np.flatnonzero(begins)
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    up, down = _POWERS.upto(len(data))
    # Blanks count nothing, so the sum up to the next word is the word's own.
    sums = np.add.reduceat(np.where(inside, _LOWER[data], np.uint64(0)) * up, at) * down[at]
    return np.searchsorted(starts, at, "right") - 1, _mixed(sums)


def _pieces(bounds: np.ndarray, data: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, end of rows, bytes) of about ``PIECE`` bytes; a longer row comes in several, cut at blanks only."""
    row, rows = 0, len(bounds) - 1
    while row < rows:
        last = max(row + 1, int(np.searchsorted(bounds, bounds[row] + PIECE, "right")) - 1)
        low, high = int(bounds[row]), int(bounds[last])
        while low < high or high == int(bounds[row]):
            cut = high
            if last == row + 1 and high - low > PIECE:
                blanks = np.flatnonzero(_SPACE[data[low : low + PIECE]])
                if len(blanks):
                    cut = low + int(blanks[-1]) + 1
                else:  # a word longer than a piece stays whole
                    ahead = np.flatnonzero(_SPACE[data[low + PIECE : high]])
                    cut = low + PIECE + int(ahead[0]) + 1 if len(ahead) else high
            yield row, last, data[low:cut]
            low = cut
            if low >= high:
                break
        row = last


def shingle_sets(bounds: np.ndarray, data: np.ndarray, width: int = WIDTH) -> list[np.ndarray]:
    """Each row's distinct shingles as sorted 64-bit hashes."""
    words: list[list[np.ndarray]] = [[] for _ in range(len(bounds) - 1)]
    for first, end, part in _pieces(bounds, data):
        starts = (bounds[first:end] - bounds[first]) if end > first + 1 else np.zeros(1, np.int64)
        row, hashes = word_hashes(part, starts)
        cuts = np.searchsorted(row, np.arange(end - first + 1))
        for i in range(end - first):
            words[first + i].append(hashes[cuts[i] : cuts[i + 1]])
    return [_shingles(np.concatenate(w) if len(w) != 1 else w[0], width) if w else np.zeros(0, np.uint64) for w in words]


def _shingles(words: np.ndarray, width: int) -> np.ndarray:
    if not len(words):
        return words
    span = min(width, len(words))
    total = np.full(len(words) - span + 1, span, np.uint64)
    for i in range(span):
        total = total * _MIX[3] + words[i : len(words) - span + 1 + i] * _MIX[2]
    return np.unique(_mixed(total))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Few rows at a time; what Arrow holds no longer goes back to the system with each batch."""
    for whole in batches:
        for low in range(0, whole.num_rows, SLICE):
            yield whole.slice(low, SLICE)
        pa.default_memory_pool().release_unused()


def _sets_of(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            sets = shingle_sets(*utf8(batch.column("text")), width)
            sizes = pa.array([len(s) for s in sets], pa.int32())
            packed = pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("id"), sizes, packed], ["doc_id", "id", "n", "shingles"])

    return run


def _set(packed: pa.Scalar) -> np.ndarray:
    return np.frombuffer(packed.as_buffer(), "<u8")


# --- the global order --------------------------------------------------------------------------------


def hot_shingles(sets: DataFrame, hot: int = HOT, most: int = HOT_SHINGLES) -> np.ndarray:
    """Shingles that many sets have, by how often they were seen: at most ``most`` of them, in falling order.

    Each task counts its share whole and names what it saw twice; the sums of these need not be exact.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [data[bounds[0] : bounds[-1]].copy().view("<u8") for bounds, data in (utf8(batch.column(0)) for batch in batches)]
        every = np.concatenate(held) if held else np.zeros(0, np.uint64)
        held.clear()
        every.sort()
        again, more = np.unique(every[1:][every[1:] == every[:-1]], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(again.view(np.int64)), pa.array(more.astype(np.int64) + 1)], ["shingle", "seen"])

    seen = sets.select("shingles").mapInArrow(run, "shingle bigint, seen bigint").groupBy("shingle").agg(F.sum("seen").alias("seen"))
    rows = seen.where(F.col("seen") >= hot).orderBy(F.col("seen").desc(), "shingle").limit(most).select("shingle").collect()
    return np.array([r[0] for r in rows], np.int64).view(np.uint64)


class Order:
    """Shingles by hash, hot ones behind the others and the hottest last."""

    def __init__(self, hot: np.ndarray):
        self.by_hash = np.sort(hot)
        self.heat = np.empty(len(hot), np.int64)
        self.heat[np.searchsorted(self.by_hash, hot)] = len(hot) - np.arange(len(hot))

    def of(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places that put sorted shingles in order, and which shingles are hot."""
        if not len(self.by_hash):
            return np.arange(len(shingles)), np.zeros(len(shingles), bool)
        at = np.minimum(np.searchsorted(self.by_hash, shingles), len(self.by_hash) - 1)
        heat = np.where(self.by_hash[at] == shingles, self.heat[at], 0)
        return np.argsort(heat, kind="stable"), heat > 0


# --- pairs by common first shingles ------------------------------------------------------------------


def first_shingles(sets: DataFrame, hot: np.ndarray, percent: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """(``shingle``, ``hot``, ``place``, ``id``, ``n``, ``keep``): of each set the first ones in order, as many as a partner at ``percent`` must meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = Order(hot)
        for batch in _slices(batches):
            found, often, rows, at = [np.zeros(0, np.uint64)], [np.zeros(0, bool)], [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
            for i, packed in enumerate(batch.column("shingles")):
                shingles = _set(packed)
                count = len(shingles) - -(-percent * len(shingles) // 100) + 1
                if len(shingles):
                    places, is_hot = order.of(shingles)
                    found.append(shingles[places[:count]])
                    often.append(is_hot[places[:count]])
                    rows.append(np.full(count, i))
                    at.append(np.arange(count, dtype=np.int32))
            picked = batch.select(["id", "n", *keep]).take(pa.array(np.concatenate(rows)))
            firsts = [pa.array(np.concatenate(found).view(np.int64)), pa.array(np.concatenate(often)), pa.array(np.concatenate(at))]
            yield pa.RecordBatch.from_arrays([*firsts, *picked.columns], ["shingle", "hot", "place", "id", "n", *keep])

    kinds = "".join(f", {c} {sets.schema[c].dataType.simpleString()}" for c in keep)
    return sets.select("id", "n", "shingles", *keep).mapInArrow(run, "shingle bigint, hot boolean, place int, id bigint, n int" + kinds)


def meetings(left: DataFrame, right: DataFrame, percent: int, by: tuple[str, ...] = (), where: Column | None = None, same: bool = False) -> DataFrame:
    """(``a``, ``b``, ``some``, ``by``): a row for each first shingle in which two owners that may be similar by ``percent`` meet.

    Of the common shingles that such a pair needs, the first ``some`` stand, in both sets, before all but
    ``needed - some`` others: only shingles at such a place are compared, and ``some`` of them must be common. So what
    near copies share behind the shingles they have to themselves makes no rows. ``same``: both sides are one table,
    and each pair comes once.
    """
    left, right = (side.drop("hot") for side in (left, right))
    both = left.withColumnsRenamed({"id": "a", "n": "n_a", "place": "place_a"}).join(right.withColumnsRenamed({"id": "b", "n": "n_b", "place": "place_b"}), ["shingle", *by])
    both = both.where("a < b" if same else "a <> b")
    both = both.where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
    # common / (n_a + n_b - common) >= percent / 100
    needed = f"({percent} * (n_a + n_b) + {99 + percent}) div {100 + percent}"
    # The stored first shingles reach for needed - (ceil(percent * n) - 1) common ones.
    some = f"least({needed} - ((greatest(n_a, n_b) * {percent} + 99) div 100 - 1), 1 + least(n_a, n_b) div {SOME})"
    both = both.where(f"place_a < n_a - {needed} + {some} and place_b < n_b - {needed} + {some}")
    if where is not None:
        both = both.where(where)
    return both.select("a", "b", F.expr(some).alias("some"), *by)


def met(left: DataFrame, right: DataFrame, percent: int, by: tuple[str, ...] = (), where: Column | None = None, same: bool = False) -> DataFrame:
    """Pairs (``a``, ``b``) of first shingles' owners that may be similar by ``percent``: those that meet often enough."""
    counted = meetings(left, right, percent, by, where, same).groupBy("a", "b", "some", *by).agg(F.count("*").alias("common"))
    return counted.where("common >= some").select("a", "b", *by)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(``a``, ``b``, ``common``, ``joint``) of the pairs whose whole sets are similar by ``percent``."""
    pairs = kept(pairs.select("a", "b").distinct(), "jaccard-candidates")
    ids = kept(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "jaccard-candidate-ids")
    held = kept(sets.join(_small(ids), "id", "left_semi").select("id", "shingles").mapInArrow(_arrays, "id bigint, shingles array<bigint>"), "jaccard-candidate-sets")
    both = pairs.join(held.withColumnsRenamed({"id": "a", "shingles": "of_a"}), "a").join(held.withColumnsRenamed({"id": "b", "shingles": "of_b"}), "b")
    # In the JVM rows pass one by one; batches of pairs of long sets would fill a Python worker.
    counted = both.select("a", "b", F.expr("size(array_intersect(of_a, of_b))").cast("bigint").alias("common"), F.expr("size(of_a) + size(of_b)").alias("sizes"))
    return counted.select("a", "b", "common", F.expr("sizes - common").alias("joint")).where(f"100 * common >= {percent} * joint")


def _arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches):
        sets = [_set(packed).view("<i8") for packed in batch.column("shingles")]
        bounds = np.cumsum([0, *map(len, sets)], dtype=np.int32)
        flat = pa.array(np.concatenate(sets) if sets else np.zeros(0, np.int64))
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.ListArray.from_arrays(pa.array(bounds), flat)], ["id", "shingles"])


# --- levels ------------------------------------------------------------------------------------------


def few_pivots(sets: DataFrame, most: int, shingles: int) -> list[tuple[int, np.ndarray]]:
    """The first sets by hash, ``most`` at the most, that hold ``shingles`` together at the most."""
    drawn = sets.select("id", "n").orderBy(F.xxhash64("id", F.lit("pivot")), "id").limit(most).collect()
    sizes = np.cumsum([r.n for r in drawn])
    ids = [r.id for r, size in zip(drawn, sizes, strict=True) if size <= shingles]
    rows = sets.where(F.col("id").isin(ids)).select("id", "shingles").collect() if ids else []
    return sorted((r.id, np.frombuffer(r.shingles, "<u8")) for r in rows)


def to_few(sets: DataFrame, pivots: list[tuple[int, np.ndarray]], percent: int) -> DataFrame:
    """(``id``, ``pivot``, ``common``, ``joint``) of all sets and pivots that are similar by ``percent``; the pivots lie in memory."""
    ids = np.array([i for i, _ in pivots], np.int64)
    sizes = np.array([len(s) for _, s in pivots], np.int64)
    owners = np.repeat(np.arange(len(pivots), dtype=np.int32), sizes)
    every = np.concatenate([s for _, s in pivots]) if pivots else np.zeros(0, np.uint64)
    order = np.argsort(every, kind="stable")
    every, owners = every[order], owners[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distinct, low = np.unique(every, return_index=True)
        high = np.append(low[1:], len(every))
        for batch in _slices(batches):
            out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(4)]
            for set_id, packed in zip(batch.column("id").to_pylist(), batch.column("shingles"), strict=True):
                shingles = _set(packed)
                if not len(distinct) or not len(shingles):
                    continue
                at = np.minimum(np.searchsorted(distinct, shingles), len(distinct) - 1)
                at = at[distinct[at] == shingles]
                if 100 * len(at) < percent * len(shingles):
                    continue
                spans = high[at] - low[at]
                places = np.repeat(low[at] - np.append(0, np.cumsum(spans)[:-1]), spans) + np.arange(spans.sum())
                common = np.bincount(owners[places], minlength=len(ids))
                joint = sizes + len(shingles) - common
                near = np.flatnonzero((100 * common >= percent * joint) & (common > 0))
                for values, more in zip(out, (np.full(len(near), set_id), ids[near], common[near], joint[near]), strict=True):
                    values.append(more)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v), pa.int64()) for v in out], ["id", "pivot", "common", "joint"])

    return sets.select("id", "shingles").mapInArrow(run, "id bigint, pivot bigint, common bigint, joint bigint")


def to_many(sets: DataFrame, pivots: DataFrame, hot: np.ndarray, percent: int) -> DataFrame:
    """As ``to_few``, for pivots that are a table."""
    pairs = met(first_shingles(pivots, hot, percent), first_shingles(sets, hot, percent), percent)
    found = verified(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), sets, percent)
    turned = found.select(F.col("b").alias("id"), F.col("a").alias("pivot"), "common", "joint")
    both = found.select(F.col("a").alias("id"), F.col("b").alias("pivot"), "common", "joint").unionByName(turned)
    own = pivots.select("id", F.col("id").alias("pivot"), F.col("n").cast("bigint").alias("common"), F.col("n").cast("bigint").alias("joint"))
    chosen = pivots.select(F.col("id").alias("pivot"))
    return both.join(chosen, "pivot", "left_semi").select("id", "pivot", "common", "joint").unionByName(own)


def links(
    sets: DataFrame, percent: int = PERCENT, pivots: int = PIVOTS, growth: int = GROWTH, hot: int = HOT, gone: DataFrame | None = None
) -> DataFrame:
    """Edges (``a``, ``b``) between ``sets`` (``id``, ``n``, ``shingles``) at ``percent`` or more: all those that components need.

    ``gone`` has the ids of sets that take no part.
    """
    # Twice the distance: 1 - s' = 2 * (1 - s).
    wide = max(1, 2 * percent - 100)
    order = hot_shingles(sets, hot)
    sets = sets.select("id", "n", "shingles")
    rest = _without(sets, gone)
    edges, level, left = None, pivots, rest.count()
    while left:
        if level >= left and level > pivots:  # every set that is left is a pivot: its links are links to pivots
            firsts = kept(first_shingles(rest, order, percent), "jaccard-firsts")
            firsts, edges = _starred(firsts, sets, edges, percent)
            return _more(edges, _met_roots(firsts, firsts, sets, percent, same=True))
        if level == pivots:
            near = to_few(rest, few_pivots(rest, pivots, PIVOT_SHINGLES), wide)
        else:
            share = F.pmod(F.xxhash64("id", F.lit("pivot"), F.lit(level)), F.lit(1 << 30)) < int(level / left * (1 << 30))
            near = to_many(rest, kept(rest.where(share), "jaccard-pivots"), order, wide)
        near = kept(near, "jaccard-near")
        found, homes = _regions(near, sets, edges, order, percent, pivots)
        edges = kept(_more(edges, found), "jaccard-edges")
        # The sets are stored once; what has gone is told by id.
        left, level = left - homes.count(), level * growth
        gone = kept(_more(gone, homes.select("id")), "jaccard-gone")
        rest = _without(sets, gone)
    return edges if edges is not None else sets.sparkSession.createDataFrame([], "a bigint, b bigint")


def _without(sets: DataFrame, gone: DataFrame | None) -> DataFrame:
    return sets if gone is None else sets.join(_small(gone), "id", "left_anti")


def _small(ids: DataFrame) -> DataFrame:
    """Ids for a join with larger tables: sent to every task up to 8 MB of them (16 with roots), else the join is Spark's to choose."""
    return F.broadcast(ids) if ids.count() <= HOT_SHINGLES else ids


def _more(edges: DataFrame | None, found: DataFrame) -> DataFrame:
    return found if edges is None else edges.unionByName(found)


def _regions(near: DataFrame, sets: DataFrame, edges: DataFrame | None, order: np.ndarray, percent: int, pivots: int) -> tuple[DataFrame, DataFrame]:
    """Links found in one level's Voronoi regions, and (``id``, ``pivot``) of each region's members.

    ``near`` has all distances to pivots up to twice the reach. As long as it settles half of the guests, some are
    drawn as ``pivots`` themselves, among the members they face: that finds all links of those, and ties others.
    """
    within = near.where(f"100 * common >= {percent} * joint")
    found = within.where("id <> pivot").select(F.col("id").alias("a"), F.col("pivot").alias("b"))
    nearest = F.max_by(F.struct("pivot", "common", "joint"), F.struct(F.col("common") / F.col("joint"), -F.col("pivot")))
    homes = kept(within.groupBy("id").agg(nearest.alias("home")).select("id", "home.*"), "jaccard-homes")
    far = (1 - F.col("common") / F.col("joint")).alias("far")
    every = homes.where("id <> pivot").select("id", "pivot", far)
    guests = near.where(f"100 * common < {percent} * joint").select("id", "pivot", far)
    reach, before = 1 - percent / 100, None
    while True:
        guests = _untied(guests, _more(edges, found))
        members, guests = (kept(df, "jaccard-facing") for df in _facing(every, guests, reach))
        ids = kept(guests.select("id").distinct(), "jaccard-guest-ids")
        left = ids.count()
        if not left:
            return found, homes
        drawn = few_pivots(sets.join(_small(ids), "id", "left_semi"), pivots, PIVOT_SHINGLES) if before is None or 2 * left <= before else []
        if not drawn:
            break
        faced = sets.join(_small(members.select("id")), "id", "left_semi")
        # A guest is a member of another region at times, but no partner of itself.
        links = to_few(faced, drawn, percent).where("id <> pivot").select(F.col("id").alias("a"), F.col("pivot").alias("b"))
        found, before = kept(found.unionByName(links), "jaccard-boundary"), left
        if len(drawn) == left:
            return found, homes
        settled = sets.sparkSession.createDataFrame([(i,) for i, _ in drawn], "id bigint")
        guests = guests.join(settled, "id", "left_anti")
    regions = {"m": members, "g": guests}
    firsts = {k: first_shingles(sets.join(df, "id"), order, percent, ("pivot", "far")).withColumnRenamed("far", f"far_{k}") for k, df in regions.items()}
    inside = F.col("far_m") >= F.col("far_g") - reach - 1e-9  # rounding may only widen a window
    pairs = met(firsts["m"], firsts["g"], percent, ("pivot",), inside)
    pairs = verified(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), sets, percent)
    return found.unionByName(pairs.select("a", "b")), homes


def _untied(guests: DataFrame, edges: DataFrame) -> DataFrame:
    """Guests that ``edges`` do not tie to their pivot: what is tied to it is tied to all members of the region."""
    tied = kept(components(edges), "jaccard-tied")
    for name in ("id", "pivot"):
        roots = tied.select(F.col("node").alias(name), F.col("root").alias(f"{name}_root"))
        guests = guests.join(roots, name, "left").withColumn(f"{name}_root", F.coalesce(f"{name}_root", name))
    return kept(guests.where("id_root <> pivot_root").select("id", "pivot", "far"), "jaccard-guests")


def _facing(members: DataFrame, guests: DataFrame, reach: float) -> tuple[DataFrame, DataFrame]:
    """Members and guests that can be near each other by what their region holds: its guests' least and its members' greatest distance."""
    slack = reach + 1e-9
    nearest = guests.groupBy("pivot").agg(F.min("far").alias("far_g"))
    members = members.join(nearest, "pivot").where(F.col("far") >= F.col("far_g") - slack).select("id", "pivot", "far")
    widest = members.groupBy("pivot").agg(F.max("far").alias("far_m"))
    return members, guests.join(widest, "pivot").where(F.col("far") <= F.col("far_m") + slack).select("id", "pivot", "far")


def _met_roots(left: DataFrame, right: DataFrame, sets: DataFrame, percent: int, same: bool = False) -> DataFrame:
    """Links (``a``, ``b``) of sets that no link ties yet, by first shingles with their ``root``."""
    sides = (side.withColumnRenamed("root", f"root_{x}") for x, side in (("a", left), ("b", right)))
    pairs = met(*sides, percent, where=F.col("root_a") != F.col("root_b"), same=same)
    return verified(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), sets, percent).select("a", "b")


def _starred(firsts: DataFrame, sets: DataFrame, edges: DataFrame | None, percent: int) -> tuple[DataFrame, DataFrame | None]:
    """First shingles of several roots, and the links, after the owners of each shingle have met its least owner alone.

    That makes no more pairs than there are rows, and ties groups of near copies that no pivot has reached, whose
    pairs need not be made then. It is repeated as long as it halves the pairs that are left.
    """
    before = None
    while True:
        firsts = kept(_between(firsts, edges), "jaccard-between")
        owners = firsts.groupBy("shingle").agg(F.count("*").alias("owners"))
        rows, pairs = owners.agg(F.sum("owners"), F.sum(F.expr("owners * (owners - 1) div 2"))).first()
        if not rows or pairs <= rows or (before is not None and 2 * pairs > before):
            return firsts, edges
        before = pairs
        least = firsts.join(firsts.groupBy("shingle").agg(F.min("id").alias("id")), ["shingle", "id"], "left_semi")
        edges = kept(_more(edges, _met_roots(least, firsts, sets, percent)), "jaccard-edges")


def _between(firsts: DataFrame, edges: DataFrame | None) -> DataFrame:
    """First shingles (``shingle``, ``id``, ``n``) with the ``root`` that ``edges`` tie each set to, of shingles that more than one root has.

    Sets that are tied need no comparison, so what a group of near copies has to itself makes no pairs. Shingles that
    are not ``hot`` have few rows each and are told within their groups, after one shuffle; the hot ones are a bounded
    list, summed before the shuffle, and those of several roots are sent to every task.
    """
    if edges is None:
        rooted = firsts.withColumn("root", F.col("id"))
    else:
        tied = kept(components(edges), "jaccard-tied").select(F.col("node").alias("id"), "root")
        rooted = firsts.drop("root").join(_small(tied), "id", "left").withColumn("root", F.coalesce("root", "id"))
    is_hot = F.col("hot") if "hot" in firsts.columns else F.lit(False)
    ends, group = {"low": F.min("root"), "high": F.max("root")}, Window.partitionBy("shingle")
    seldom = rooted.where(~is_hot).withColumns({k: end.over(group) for k, end in ends.items()}).where("low < high")
    often = rooted.where(is_hot)
    mixed = often.groupBy("shingle").agg(*(end.alias(k) for k, end in ends.items())).where("low < high")
    often = often.join(_small(kept(mixed.select("shingle"), "jaccard-mixed")), "shingle", "left_semi")
    names = ["shingle", "id", "n", "root", *(c for c in ("hot", "place") if c in firsts.columns)]
    return seldom.select(names).unionByName(often.select(names))


def similar_documents(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = WIDTH, percent: int = PERCENT, pivots: int = PIVOTS, growth: int = GROWTH, hot: int = HOT
) -> DataFrame:
    """(``doc_id``, ``n_shingles``, ``component_id``) of every row of ``docs``."""
    rows = docs.select(column(doc_id).alias("doc_id"), column(text).cast("string").alias("text"), F.monotonically_increasing_id().alias("id"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(_sets_of(width), f"doc_id {kind}, id bigint, n int, shingles binary")
    keys = {"key1": F.xxhash64(F.lit(1), "shingles"), "key2": F.xxhash64("shingles", F.lit(2))}
    # The ids are stored together with the sets, so no later job can number them anew.
    with small_batches(docs.sparkSession, SLICE):
        sets = kept(found.withColumns(keys), "jaccard-sets")
        some = sets.where("n > 0")
        firsts = some.groupBy("key1", "key2").agg(F.min("id").alias("first"))
        of_row = kept(some.select("doc_id", "id", "n", "key1", "key2").join(firsts, ["key1", "key2"]).select("doc_id", "id", "n", "first"), "jaccard-rows")
        copies = of_row.where("id <> first").select("id")
        edges = kept(links(some, percent, pivots, growth, hot, copies), "jaccard-links")
        roots = kept(components(edges), "jaccard-roots").select(F.col("node").alias("first"), "root")

    placed = kept(of_row.join(roots, "first", "left").withColumn("root", F.coalesce("root", "first")), "jaccard-placed")
    least = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    size = F.col("n").cast("bigint").alias("n_shingles")
    alone = sets.where("n = 0").select("doc_id", size, F.col("doc_id").alias("component_id"))
    return placed.join(least, "root").select("doc_id", size, "component_id").unionByName(alone)


def op13_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's number of 4-word shingles and component at a similarity of 0.85."""
    return similar_documents(table(spark, sf_dir, "documents"))
