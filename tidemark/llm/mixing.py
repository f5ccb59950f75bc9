"""Mixing sources to target weights by pivotal dependent rounding.

Every source has a target of words; target by size gives each of its documents the same wanted number of
copies, a whole part and a fraction. The fraction is rounded in pairs: mass in words moves at random between
the fractions of two documents until one of them is 0 or 1, so that each document keeps its expected copies
and the pair its words. The other goes on to the next pair. Documents are dealt to buckets by hash; each
bucket leaves at most one open document a source, and these meet in a tree of fixed fan-in, level by level,
until one is left for each source. That last one is rounded by its fraction: a source is off its target by
less than one document. Where sources are so many that their open documents would fill a group, each bucket of
the upper levels is split by a hash of the source, whose documents stay together.

Random numbers come from a seed, level and group, and documents in a group are ordered by their hashes, so
reruns agree.

Defined cases: null and empty texts have size 0 and are never taken, and a source that has no others has target
0; a null source is a source of its own,
last in order; repeated rows are counted each and may get different numbers of copies; an empty table gives
an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import column
from tidemark.llm.common import fresh, kept, one_of_each, row_keys, table

# The words of a text, and the mix.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0

BUCKET_ROWS = 4_096
FAN_IN = 16
SEED = 11


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(``source``, ``source_size``, ``target``) from (``source``, ``size``).

    Targets rise in proportion to the weights until they reach ``most`` times their source's size. The level is
    the largest that some set of stopped sources gives: each such set bounds it from below, the right one meets
    it. One row a source is ordered in one task; sums over its rows stream through it.
    """
    sources = kept(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.array(*map(F.lit, weights))[(rank % len(weights)).cast("int")]
    stop = F.lit(most) * F.col("source_size")
    weighed = sources.withColumn("weight", weight).withColumn("stop", stop)
    total = Window.partitionBy()
    before = Window.orderBy(F.col("stop") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    # The rows before one are stopped; the row itself and those after it still rise.
    left = share * F.sum("source_size").over(total) - F.coalesce(F.sum("stop").over(before), F.lit(0.0))
    rising = F.sum("weight").over(total) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    leveled = weighed.withColumn("level", left / rising)
    level = F.max("level").over(total)
    return kept(leveled.select("source", "source_size", F.least("stop", level * F.col("weight")).alias("target")), "targets")


def pair_off(rows: pd.DataFrame, rng: np.random.Generator) -> pd.DataFrame:
    """Rounds the ``fraction`` of rows in pairs within each source, weighed by ``size``; at most one a source stays open."""
    fraction, size = rows["fraction"].to_numpy(float, copy=True), rows["size"].to_numpy(float)
    source = rows["slot"].to_numpy()
    chance = rng.random(len(rows))
    held: int | None = None
    for i in range(len(rows)):
        if held is not None and source[held] != source[i]:
            held = None
        if not 0.0 < fraction[i] < 1.0:
            continue
        if held is None:
            held = i
            continue
        a, b, p, q = size[held], size[i], fraction[held], fraction[i]
        up, down = min(a * (1 - p), b * q), min(a * p, b * (1 - q))  # words that may move to the first, and from it
        if chance[i] * (up + down) < down:
            p, q = (1.0 if up == a * (1 - p) else p + up / a), (0.0 if up == b * q else q - up / b)
        else:
            p, q = (0.0 if down == a * p else p - down / a), (1.0 if down == b * (1 - q) else q + down / b)
        fraction[held], fraction[i] = p, q
        if not 0.0 < p < 1.0:
            held = i if 0.0 < q < 1.0 else None
    return rows.assign(fraction=fraction)


def _level(seed: int, level: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["slot", "key1", "key2"], kind="stable")
        group = [int(rows[name].iloc[0]) for name in ("bucket", "share")]
        return pair_off(rows, np.random.default_rng([seed, level, *group[: 1 + (group[1] > 0)]]))

    return run


def _climbed(open_rows: DataFrame, fan_in: int, shares: int) -> DataFrame:
    """Open rows, one a source of each bucket, in the groups of the next level: about ``sources * fan_in / shares`` in each."""
    return open_rows.withColumns({"bucket": F.floor(F.col("bucket") / fan_in).cast("bigint"), "share": F.pmod(F.xxhash64("slot"), F.lit(shares))})


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", bucket_rows: int = BUCKET_ROWS, fan_in: int = FAN_IN, seed: int = SEED) -> DataFrame:
    """One row for each set of repeated rows: keys, ``doc_id``, ``size``, ``n_rows``, ``source_size``, ``target``,
    ``base`` copies of each row, and ``extra``, the number of rows that get one copy more."""
    first, second = row_keys(docs)
    size = F.coalesce(F.regexp_count(column(text), F.lit(WORD)), F.lit(0)).cast("bigint")
    rows = docs.select(first.alias("key1"), second.alias("key2"), column(doc_id).alias("doc_id"), column(source).cast("string").alias("source"), size.alias("size"))
    units = kept(rows.groupBy("key1", "key2", "doc_id", "source", "size").agg(F.count("*").alias("n_rows")), "units")
    of_source = targets(units.select("source", (F.col("size") * F.col("n_rows")).alias("size")))
    # A source of empty texts alone has nothing to take.
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("wanted")
    of_source = of_source.select(F.col("source").alias("of_source"), "source_size", "target", wanted)
    units = units.join(of_source, F.col("source").eqNullSafe(F.col("of_source"))).drop("of_source")
    units = units.withColumn("base", F.when(F.col("size") > 0, F.floor("wanted")).otherwise(0).cast("bigint"))
    # Of n equal rows the whole part of n fractions is settled at once; the rest is one row's fraction.
    part = F.when(F.col("size") > 0, F.col("n_rows") * (F.col("wanted") - F.col("base"))).otherwise(F.lit(0.0))
    units = units.withColumn("part", part).withColumn("sure", F.floor("part").cast("bigint")).withColumn("fraction", F.col("part") - F.col("sure"))
    units = kept(units.drop("part", "wanted"), "weighed")

    buckets = max(1, -(-units.count() // bucket_rows))
    slot = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit(""))
    open_rows = units.where("fraction > 0").select(slot.alias("slot"), "key1", "key2", F.col("size"), "fraction")
    open_rows = open_rows.withColumns({"bucket": F.pmod(F.xxhash64("key1", "key2"), F.lit(buckets)), "share": F.lit(0).cast("bigint")})
    shares = max(1, -(-of_source.count() * fan_in // bucket_rows))
    settled, level = [], 0
    while True:
        schema = open_rows.schema
        rounded = kept(open_rows.groupBy("bucket", "share").applyInPandas(_level(seed, level), schema), "rounded")
        still = (F.col("fraction") > 0) & (F.col("fraction") < 1)
        settled.append(rounded.where(~still).select("key1", "key2", F.col("fraction").cast("bigint").alias("one")))
        open_rows = rounded.where(still)
        if buckets == 1:
            break
        buckets, level = -(-buckets // fan_in), level + 1
        open_rows = _climbed(open_rows, fan_in, shares)
    # One open document a source at most: its fraction is its chance.
    draw = F.pmod(F.xxhash64("key1", "key2", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    settled.append(open_rows.select("key1", "key2", (draw < F.col("fraction")).cast("bigint").alias("one")))
    ones = settled[0]
    for more in settled[1:]:
        ones = ones.unionByName(more)
    mixed = units.join(kept(ones, "ones"), ["key1", "key2"], "left")
    return mixed.withColumn("extra", F.col("sure") + F.coalesce("one", F.lit(0))).drop("one", "sure", "fraction")


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words that the mix takes of it."""
    mixed = mix(table(spark, sf_dir, "documents"))
    each = mixed.withColumn("at", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n_rows"))))
    copies = F.col("base") + F.when(F.col("at") <= F.col("extra"), 1).otherwise(0)
    return each.select("doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"))


def repeat_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document as often as the mix takes it."""
    mixed = mix(docs)
    rows, key1, key2 = one_of_each(docs)
    copies = fresh(rows, "_copies")
    taken = (F.col("n_rows") * F.col("base") + F.col("extra")).alias(copies)
    mixed = mixed.select(F.col("key1").alias(key1), F.col("key2").alias(key2), taken).where(column(copies) > 0)
    again = rows.join(mixed, [key1, key2]).withColumn(copies, F.explode(F.sequence(F.lit(1).cast("bigint"), column(copies))))
    return again.select(*[column(c) for c in docs.columns])
