"""Exact top-k search by tiled matrix products.

Components become integers, floor(scale * x). Queries are dealt to blocks, candidates to shards; every
(block, shard) tile is one matrix product, of which each query keeps its k best by partial selection. The
lists are merged in a tree: of up to ``fan_in`` shards at a time, until one list is left for each query.

Products are made in doubles while no sum of products can pass 2**53, in 64-bit integers up to 2**63, else in
Python's integers; all are exact. A returned score that no bigint holds raises an error.

Defined cases: vectors that are null, empty or hold a null or non-finite component, and rows without an id,
take no part; rows equal in id and vector count once, other rows with one id are candidates and queries of
their own, but none of them is a candidate for another; vectors meet only those of their own length; ties go
to the smaller id; no candidates or an empty table give an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import kept, table
from tidemark.llm.vectors import integers, kth, matrix, packed, tiled, whole_numbers

TOP = 5
SCALE = 256
EVERY = 50
BLOCK = 2_048
SHARD = 8_192
FAN_IN = 64

ORACLE = f"""
with v as (
  select vec_id, [floor({SCALE} * x::double) for x in embedding] as v from (select distinct vec_id, embedding from embeddings)
  where vec_id is not null and embedding is not null and len(embedding) > 0 and len([x for x in embedding if x is null or not isfinite(x)]) = 0
),
scored as (
  select q.vec_id as query_id, q.v, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score
  from v q join v c on c.vec_id <> q.vec_id and len(c.v) = len(q.v) where q.vec_id % {EVERY} = 0
)
select query_id, cast(rank as integer) as rank, vec_id, score from (
  select *, row_number() over (partition by query_id, v order by score desc, vec_id) as rank from scored
) where rank <= {TOP}
"""


def best_of_tile(
    queries: np.ndarray, query_ids: np.ndarray, candidates: np.ndarray, ids: np.ndarray, top: int, names: np.ndarray | None = None
) -> list[tuple[int, int, int]]:
    """(name or id of the query, candidate, score) of each query's best in one tile, candidates with its own id left out."""
    candidates = integers(candidates, 1, int(np.abs(queries).max(initial=0)) + 1)
    queries = whole_numbers(queries) if candidates.dtype == object else queries.astype(candidates.dtype)
    scores = queries @ candidates.T
    order = np.argsort(ids, kind="stable")
    scores, ids = scores[:, order], ids[order]  # columns by id, so that equal scores stand in order
    found = []
    for row, query, name in zip(scores, query_ids, query_ids if names is None else names, strict=True):
        others = np.flatnonzero(ids != query)
        row, left = row[others], ids[others]
        near = np.flatnonzero(row >= kth(row, top)) if len(row) > top else np.arange(len(row))
        near = near[np.argsort(-row[near], kind="stable")[:top]]
        found += zip([name] * len(near), left[near], row[near], strict=True)
    return found


def top_k(vectors: DataFrame, queries_of: str, top: int = TOP, scale: int = SCALE, block: int = BLOCK, shard: int = SHARD, fan_in: int = FAN_IN) -> DataFrame:
    """(``query_id``, ``rank``, ``vec_id``, ``score``): for each row that meets the SQL condition ``queries_of`` its
    ``top`` best other rows."""
    vectors = kept(packed(vectors).withColumn("row", F.monotonically_increasing_id()), "vectors")
    queries = vectors.where(queries_of).select("row", F.col("vec_id").alias("query_id"), "dim", F.col("vector").alias("query"))
    total = (queries.count(), vectors.count())

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            asked, held = np.floor(scale * matrix(left["query"])), np.floor(scale * matrix(right["vector"]))
            own = left["query_id"].to_numpy()
            found = best_of_tile(asked, own, held, right["vec_id"].to_numpy(), top, np.arange(len(left)))
        rows, own = left["row"].to_numpy(), left["query_id"].to_numpy()
        # One beyond 64 bits raises.
        of, vec_ids, scores = (np.array([int(x[i]) for x in found], np.int64) for i in range(3))
        shard_of = np.full(len(of), right["shard"].iloc[0] if len(right) else 0, np.int64)
        return pd.DataFrame({"row": rows[of], "query_id": own[of], "shard": shard_of, "vec_id": vec_ids, "score": scores})

    lists = tiled(queries, vectors, None, ["dim"], block, shard, best, "row bigint, query_id bigint, shard bigint, vec_id bigint, score bigint", total)
    shards = max(1, -(-total[1] // shard))
    while shards > fan_in:
        shards = -(-shards // fan_in)
        lists = _merged(lists.withColumn("shard", F.floor(F.col("shard") / fan_in).cast("bigint")), ["row", "query_id", "shard"], top).drop("rank")
    return _merged(lists, ["row", "query_id"], top).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _merged(lists: DataFrame, by: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("vec_id"))
    return lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other rows for every fiftieth row."""
    return top_k(table(spark, sf_dir, "embeddings"), f"vec_id % {EVERY} = 0")
