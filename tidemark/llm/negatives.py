"""Hard negatives by a vertical scan (branch and bound on decomposed vectors).

Components become integers, floor(scale * x). A shard holds its candidates by dimension. For each anchor the
dimensions are read in descending magnitude of the anchor's components; after every few of them each candidate
has a partial score, and the least and greatest the unread dimensions can still add follow from their minima
and maxima in the shard. The bitmap of candidates shrinks by these bounds:

1. positives: candidates of the anchor's label stay while their upper bound reaches the k-th best lower bound;
   the lists of all shards are merged to each anchor's first ``positives`` rows of its label.
2. negatives: the score of each positive opens a window of wanted scores. Candidates of other labels stay while
   they can still fall into a window, and are not surely behind ``negatives`` others of it. What is left when
   all dimensions are read has exact scores; each window keeps its first ones, and the shards' lists are merged.

Tiles are blocks of anchors and shards of candidates of bounded size, in the first step within a label, so a
label with a large share of the rows makes more tiles, not larger ones.

Scores are summed in doubles while no sum can pass 2**53, in 64-bit integers up to 2**63, else in Python's
integers; a returned score that no bigint holds raises an error.

Defined cases: rows without an id or label, and rows whose vector is null, empty or holds a null or non-finite
component, take no part; rows equal in id, label and vector count once, other rows with one id are rows of
their own, and none of them is a candidate for another; vectors meet only those of their own length; ties go
to the smaller id; an anchor without positives, or whose windows hold nothing, has no rows; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import column
from tidemark.llm.common import kept, table
from tidemark.llm.vectors import integers, kth, matrix, packed, tiled, whole_numbers

SCALE = 256
EVERY = 50
POSITIVES = 5
NEGATIVES = 3
#: A negative's score lies between these hundredths of the positive's.
WINDOW = (50, 95)
#: Dimensions read between two looks at the bounds.
STEP = 8
BLOCK = 1_024
SHARD = 8_192

ORACLE = f"""
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, [floor({SCALE} * x::double) for x in embedding] as v
  from (select distinct vec_id, label, embedding from embeddings)
  where vec_id is not null and label is not null and embedding is not null and len(embedding) > 0
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0
),
scored as (
  select a.vec_id as anchor_id, a.label as label, a.v as anchor, c.vec_id, c.v, c.label = a.label as same, cast(list_inner_product(a.v, c.v) as bigint) as score
  from v a join v c on c.vec_id <> a.vec_id and len(c.v) = len(a.v) where a.vec_id % {EVERY} = 0
),
positives as (
  select * from (
    select *, row_number() over (partition by anchor_id, label, anchor order by score desc, vec_id) as place from scored where same
  ) where place <= {POSITIVES}
),
wanted as (
  select p.anchor_id, p.vec_id as positive_id, n.vec_id as negative_id, p.score as positive_score, n.score as negative_score,
    row_number() over (partition by p.anchor_id, p.label, p.anchor, p.place order by n.score desc, n.vec_id) as rank
  from positives p join scored n on n.anchor_id = p.anchor_id and n.label = p.label and n.anchor = p.anchor and not n.same
    and {WINDOW[0]} * p.score <= 100 * n.score and 100 * n.score <= {WINDOW[1]} * p.score
)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score from wanted where rank <= {NEGATIVES}
"""

Bounds = Callable[[np.ndarray, np.ndarray], np.ndarray]


def scan(anchor: np.ndarray, columns: np.ndarray, least: np.ndarray, most: np.ndarray, live: np.ndarray, bounds: Bounds, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``live`` that ``bounds`` never ruled out, and their exact scores.

    ``columns`` holds one row for each dimension, ``least`` and ``most`` their extremes. ``bounds`` gets the least
    and greatest scores that each candidate can still have, and says which of them stay.
    """
    order = np.argsort(-np.abs(anchor), kind="stable")
    ends = np.stack([anchor * least, anchor * most])[:, order]
    # What the dimensions from each place on can add.
    below = np.append(np.cumsum(ends.min(axis=0)[::-1])[::-1], 0)
    above = np.append(np.cumsum(ends.max(axis=0)[::-1])[::-1], 0)
    partial = np.zeros(len(live), columns.dtype)
    for low in range(0, len(order), step):
        read = order[low : low + step]
        held = columns[read] if len(live) == columns.shape[1] else columns[np.ix_(read, live)]
        partial = partial + anchor[read] @ held
        high = min(low + step, len(order))
        stays = bounds(partial + below[high], partial + above[high])
        live, partial = live[stays], partial[stays]
        if not len(live):
            break
    return live, partial


def among_best(k: int) -> Bounds:
    """Keeps what may be among the ``k`` highest scores, ties included."""

    def bounds(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        return upper >= kth(lower, k) if len(lower) > k else np.ones(len(lower), bool)

    return bounds


def within(windows: list[tuple[int, int]], k: int) -> Bounds:
    """Keeps what may be among the ``k`` highest scores of one of the windows, ties included."""

    def bounds(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        stays = np.zeros(len(lower), bool)
        for low, high in windows:
            may = (upper >= low) & (lower <= high)
            sure = lower[may & (lower >= low) & (upper <= high)]
            if len(sure) >= k:
                may &= upper >= kth(sure, k)
            stays |= may
        return stays

    return bounds


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """The integers n with low * score <= 100 * n <= high * score."""
    return -(-low * score // 100), high * score // 100


class _Shard:
    """A tile's candidates by dimension, ordered by id, and its anchors in the same kind of numbers."""

    def __init__(self, anchors: pd.DataFrame, candidates: pd.DataFrame, scale: int):
        candidates = candidates.sort_values("vec_id", kind="stable")
        self.ids, self.rows, self.labels = (candidates[c].to_numpy() for c in ("vec_id", "row", "label"))
        asked, held = matrix(anchors["query"]), matrix(candidates["vector"])
        largest = int(np.floor(scale * np.abs(asked)).max(initial=0)) + 1
        whole = integers(held, scale, largest)
        self.columns = np.ascontiguousarray(whole.T)
        asked = np.floor(scale * asked)
        self.anchors = whole_numbers(asked) if whole.dtype == object else asked.astype(whole.dtype)
        self.least, self.most = self.columns.min(axis=1), self.columns.max(axis=1)

    def search(self, i: int, live: np.ndarray, bounds: Bounds, step: int) -> tuple[np.ndarray, np.ndarray]:
        return scan(self.anchors[i], self.columns, self.least, self.most, live, bounds, step)


def _frame(found: list[tuple], names: list[str]) -> pd.DataFrame:
    """Integers as Python has them: one beyond 64 bits raises."""
    return pd.DataFrame({name: pd.Series(np.array([int(row[i]) for row in found], np.int64)) for i, name in enumerate(names)})


def hard_negatives(
    vectors: DataFrame,
    anchors_of: str,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    share: tuple[int, int] = WINDOW,
    scale: int = SCALE,
    step: int = STEP,
    block: int = BLOCK,
    shard: int = SHARD,
    label: str = "label",
) -> DataFrame:
    """(``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``).

    Anchors are the rows that meet the SQL condition ``anchors_of`` on ``vec_id``; ``share`` bounds a negative's score in
    hundredths of the positive's.
    """
    labelled = vectors.where(column(label).isNotNull())
    rows = kept(packed(labelled, extra={"label": column(label).cast("bigint")}).withColumn("row", F.monotonically_increasing_id()), "labelled-vectors")
    anchors = rows.where(anchors_of).select(
        F.col("row").alias("query_id"), F.col("vec_id").alias("anchor_id"), "dim", "label", F.col("vector").alias("query")
    )

    def of_label(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            tile = _Shard(left, right, scale)
            for i, (query, own) in enumerate(zip(left["query_id"], left["anchor_id"], strict=True)):
                live, scores = tile.search(i, np.flatnonzero(tile.ids != own), among_best(positives), step)
                best = np.argsort(-scores, kind="stable")[:positives]
                found += zip([query] * len(best), tile.ids[live[best]], tile.rows[live[best]], scores[best], strict=True)
        return _frame(found, ["query_id", "vec_id", "row", "score"])

    asked = anchors.groupBy("dim", "label").agg(F.count("*").alias("nq"))
    held = rows.groupBy("dim", "label").agg(F.count("*").alias("nc"))
    sizes = kept(asked.join(held, ["dim", "label"]), "label-sizes")
    lists = tiled(anchors, rows, sizes, ["dim", "label"], block, shard, of_label, "query_id bigint, vec_id bigint, row bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id", "row")
    first = kept(lists.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives), "positives")

    wanted = first.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("place", "score"))).alias("found"))
    asking = anchors.join(wanted, "query_id").withColumn("scores", F.col("found.score")).drop("found")

    def in_windows(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            tile = _Shard(left, right, scale)
            for i, (query, own, label_of, scores) in enumerate(zip(left["query_id"], left["anchor_id"], left["label"], left["scores"], strict=True)):
                windows = [window(int(s), *share) for s in scores]
                others = np.flatnonzero((tile.labels != label_of) & (tile.ids != own))
                live, exact = tile.search(i, others, within([w for w in windows if w[0] <= w[1]], negatives), step)
                for place, (low, high) in enumerate(windows, 1):
                    inside = np.flatnonzero((exact >= low) & (exact <= high))
                    best = inside[np.argsort(-exact[inside], kind="stable")[:negatives]]
                    found += zip([query] * len(best), [place] * len(best), tile.ids[live[best]], exact[best], strict=True)
        return _frame(found, ["query_id", "place", "negative_id", "negative_score"])

    total = rows.groupBy("dim").agg(F.count("*").alias("nc"))
    every = kept(anchors.groupBy("dim").agg(F.count("*").alias("nq")).join(total, "dim"), "dim-sizes")
    # Candidates keep their label as a value; tiles of the second step are dealt by length alone.
    lists = tiled(asking, rows, every, ["dim"], block, shard, in_windows, "query_id bigint, place bigint, negative_id bigint, negative_score bigint")
    order = Window.partitionBy("query_id", "place").orderBy(F.col("negative_score").desc(), "negative_id")
    ranked = lists.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= negatives)
    chosen = first.select("query_id", F.col("place").cast("bigint").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = ranked.join(chosen, ["query_id", "place"]).join(anchors.select("query_id", "anchor_id"), "query_id")
    return named.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives for each of the five positives of every fiftieth row, one label in seven moved on."""
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", moved), f"vec_id % {EVERY} = 0")
