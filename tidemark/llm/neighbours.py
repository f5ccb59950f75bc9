"""Approximate nearest neighbours: a forest of random-projection trees under one priority queue.

Index: every distinct vector goes down each tree of the forest to a leaf. A tree's planes are random
directions that cut a bounded sample at its median; a table of planes is all that tasks need. To make the
largest inner product the smallest angle, a vector gets one more component that brings it to the length of
the longest; a query gets a zero.

Search: one priority queue for each query holds nodes of all trees, ordered by how far the query is on the
wrong side of the planes passed (their squares summed). The best node is expanded until the leaves reached
hold ``probe`` times the number of vectors, counted with repetition over the trees. Queries meet the vectors of
their leaves in tiles of bounded size; original vectors are ranked there by exact inner products, and the
lists of all leaves are merged.

Of equal vectors only the ``top + 1`` smallest ids are indexed: no others can be among the ``top``, as ties go
to smaller ids and only the query itself is left out. So a vector that many rows share makes no large leaf.

On vectors without any structure the nearest are hardly nearer than others, and a recall of 0.9 needs leaves
with about half of all vectors; ``probe`` is set for that case and may be far lower for clustered vectors.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite component, and rows without an
id, take no part; rows equal in id and vector count once, other rows with one id are candidates and queries of
their own, but none of them is a candidate for another; vectors meet only those of their own length; no
candidates or an empty table give an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import kept, table
from tidemark.llm.vectors import matrix, packed, tiled

TOP = 20
EVERY = 20
TREES = 10
LEAF = 2_048
PROBE = 1.5
LEAST_LEAVES = 32
SAMPLE_ROWS = 16_384
DEEPEST = 10
BLOCK = 1_024
SHARD = 4_096


@dataclass(frozen=True)
class Forest:
    """Planes of all inner nodes, by tree and heap order (node k has the children 2k + 1 and 2k + 2)."""

    depth: int
    directions: np.ndarray  # trees x nodes x dim + 1
    offsets: np.ndarray  # trees x nodes
    longest: float

    def lift(self, vectors: np.ndarray) -> np.ndarray:
        """Vectors with the component that brings them to the longest one's length."""
        rest = np.sqrt(np.maximum(self.longest**2 - (vectors * vectors).sum(1), 0))
        return np.column_stack([vectors, rest])

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree."""
        lifted, found = self.lift(vectors), []
        for directions, offsets in zip(self.directions, self.offsets, strict=True):
            node = np.zeros(len(lifted), np.int64)
            for _ in range(self.depth):
                side = np.einsum("ij,ij->i", lifted, directions[node]) > offsets[node]
                node = 2 * node + 1 + side
            found.append(node - ((1 << self.depth) - 1))
        return np.stack(found, axis=1) if found else np.zeros((len(lifted), 0), np.int64)

    def search(self, query: np.ndarray, sizes: np.ndarray, wanted: float) -> list[tuple[int, int]]:
        """(tree, leaf) in the order of the shared queue, until their ``sizes`` add up to ``wanted``."""
        lifted = np.append(query / np.sqrt((query * query).sum()) * self.longest, 0.0)
        margins = self.directions @ lifted - self.offsets
        inner = (1 << self.depth) - 1
        queue = [(0.0, tree, 0) for tree in range(len(margins))]
        found, held = [], 0
        while queue and held < wanted:
            cost, tree, node = heapq.heappop(queue)
            if node >= inner:
                found.append((tree, node - inner))
                held += sizes[tree, node - inner]
                continue
            margin = float(margins[tree, node])
            far = cost + margin * margin
            heapq.heappush(queue, (far if margin > 0 else cost, tree, 2 * node + 1))
            heapq.heappush(queue, (cost if margin > 0 else far, tree, 2 * node + 2))
        return found


def plant(sample: np.ndarray, longest: float, depth: int, trees: int, seed: int) -> Forest:
    """A forest whose planes cut the sample at its medians."""
    rng = np.random.default_rng(seed)
    dim, nodes = sample.shape[1] + 1, (1 << depth) - 1
    forest = Forest(depth, rng.normal(size=(trees, nodes, dim)), np.zeros((trees, nodes)), longest)
    forest.directions[:] /= np.sqrt((forest.directions**2).sum(2, keepdims=True))
    lifted = forest.lift(sample)
    for tree in range(trees):
        held = {0: np.arange(len(lifted))}
        for node in range(nodes):
            rows = held.pop(node)
            along = lifted[rows] @ forest.directions[tree, node]
            forest.offsets[tree, node] = np.median(along) if len(rows) else 0.0
            held[2 * node + 1] = rows[along <= forest.offsets[tree, node]]
            held[2 * node + 2] = rows[along > forest.offsets[tree, node]]
    return forest


def rank_exactly(queries: np.ndarray, query_ids: np.ndarray, candidates: np.ndarray, ids: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of queries and of their best candidates, those of its own id left out, with inner products summed in one fixed order."""
    order = np.argsort(ids, kind="stable")
    candidates, ids = candidates[order], ids[order]
    rough = queries @ candidates.T
    slack = 1e-9 * max(1.0, float(np.abs(rough).max(initial=0)))
    out: tuple[list, list, list] = ([np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)])
    for i, (query, query_id, row) in enumerate(zip(queries, query_ids, rough, strict=True)):
        others = np.flatnonzero(ids != query_id)
        least = np.partition(row[others], len(others) - top)[len(others) - top] if len(others) > top else -np.inf
        near = others[row[others] >= least - slack]
        exact = (candidates[near] * query).sum(axis=1)
        best = np.argsort(-exact, kind="stable")[:top]  # candidates stand by id
        out[0].append(np.full(len(best), i))
        out[1].append(order[near[best]])
        out[2].append(exact[best])
    return tuple(np.concatenate(x) for x in out)


def nearest(
    vectors: DataFrame,
    queries_of: str,
    top: int = TOP,
    trees: int = TREES,
    leaf: int = LEAF,
    probe: float = PROBE,
    sample_rows: int = SAMPLE_ROWS,
    deepest: int = DEEPEST,
    block: int = BLOCK,
    shard: int = SHARD,
    seed: int = 5,
) -> DataFrame:
    """(``query_id``, ``rank``, ``vec_id``, ``score``): for each row that meets the SQL condition ``queries_of`` the
    ``top`` nearest others found. The forest's planes come from ``sample_rows`` vectors; every vector is indexed."""
    vectors = kept(packed(vectors, zero=False).withColumn("row", F.monotonically_increasing_id()), "vectors")
    results = []
    # One forest for each length of vectors; a table of embeddings has one.
    for dim in [r[0] for r in vectors.select("dim").distinct().orderBy("dim").collect()]:
        results.append(_nearest(vectors.where(F.col("dim") == dim), queries_of, top, trees, leaf, probe, sample_rows, deepest, block, shard, seed))
    if not results:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    found = results[0]
    for more in results[1:]:
        found = found.unionByName(more)
    return found


def _nearest(vectors: DataFrame, queries_of: str, top: int, trees: int, leaf: int, probe: float, sample_rows: int, deepest: int, block: int, shard: int, seed: int) -> DataFrame:
    same = Window.partitionBy("vector").orderBy("vec_id")
    indexed = kept(vectors.withColumn("place", F.row_number().over(same)).where(F.col("place") <= top + 1).select("vec_id", "row", "vector"), "indexed")
    total = indexed.count()
    sample = matrix(pd.Series([r[0] for r in indexed.orderBy(F.xxhash64("vec_id", F.lit("sample")), "vec_id").limit(sample_rows).select("vector").collect()]))
    longest = indexed.mapInPandas(_longest, "longest double").agg(F.max("longest")).first()[0]
    leaf = min(leaf, max(64, total // LEAST_LEAVES))
    depth = max(0, min(deepest, int(np.ceil(np.log2(max(1, total / leaf))))))
    forest = plant(sample, longest, depth, trees, seed)

    def to_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves = forest.leaves(matrix(batch.column("vector").to_pandas()))
            for tree in range(trees):
                spot = pa.array(tree * (1 << depth) + leaves[:, tree])
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("row"), spot, batch.column("vector")], ["vec_id", "row", "leaf", "vector"])

    placed = kept(indexed.mapInArrow(to_leaves, "vec_id bigint, row bigint, leaf bigint, vector binary"), "leaves")
    sizes = np.zeros(trees << depth, np.int64)
    counted = placed.groupBy("leaf").agg(F.count("*").alias("nc"))
    for row in counted.collect():  # no more rows than the forest has leaves
        sizes[row.leaf] = row.nc
    of_tree = sizes.reshape(trees, -1)

    def to_probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, leaves = [], []
            for i, query in enumerate(matrix(batch.column("vector").to_pandas())):
                found = [tree * (1 << depth) + x for tree, x in forest.search(query, of_tree, probe * total)]
                rows += [i] * len(found)
                leaves += found
            picked = batch.take(pa.array(rows, pa.int64()))
            arrays = [picked.column("row"), picked.column("vec_id"), pa.array(leaves, pa.int64()), picked.column("vector")]
            yield pa.RecordBatch.from_arrays(arrays, ["asked", "query_id", "leaf", "query"])

    queries = vectors.where(queries_of).select("vec_id", "row", "vector")
    probes = kept(queries.mapInArrow(to_probes, "asked bigint, query_id bigint, leaf bigint, query binary"), "probes")
    asked = probes.groupBy("leaf").agg(F.count("*").alias("nq"))
    both = kept(asked.join(counted, "leaf"), "leaf-sizes")

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        place, near, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        if len(left) and len(right):
            place, near, score = rank_exactly(matrix(left["query"]), left["query_id"].to_numpy(), matrix(right["vector"]), right["vec_id"].to_numpy(), top)
        asked, query, row, vec = left["asked"].to_numpy()[place], left["query_id"].to_numpy()[place], right["row"].to_numpy()[near], right["vec_id"].to_numpy()[near]
        return pd.DataFrame({"asked": asked, "query_id": query, "row": row, "vec_id": vec, "score": score})

    lists = tiled(probes, placed, both, ["leaf"], block, shard, best, "asked bigint, query_id bigint, row bigint, vec_id bigint, score double")
    # A candidate may be found in several trees.
    lists = lists.groupBy("asked", "query_id", "row", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("asked").orderBy(F.col("score").desc(), "vec_id", "row")
    ranked = lists.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _longest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        lengths = np.sqrt((matrix(frame["vector"]) ** 2).sum(1)) if len(frame) else np.zeros(0)
        yield pd.DataFrame({"longest": [lengths.max(initial=0.0)]})


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty nearest found for every twentieth row."""
    return nearest(table(spark, sf_dir, "embeddings"), f"vec_id % {EVERY} = 0")
