"""Searches over tables with repeated ids, large values and odd rows, against SQL and brute force."""

import sys
from collections import defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from compare import differences
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
from test_tables import VECTORS, odd_vectors

from tidemark.llm import negatives, topk


def labelled_rows(seed=3):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rng.normal(0.3, 0.5, size=6)], int(rng.integers(0, 10))) for i in range(300)]
    rows += [(i, [1.0, 0.5, 0.0, 0.0, 0.0, 0.25], 1) for i in range(300, 700)]  # one vector and label that many rows share
    rows += [(50, [9.0, 1.0, 1.0, 1.0, 1.0, 1.0], 4), (50, rows[50][1], rows[50][2]), (61, [2.0, 2.0, 1.0, 0.0, 1.0, 1.0], 4), (61, [2.0, 2.0, 1.0, 0.0, 1.0, 2.0], 4)]
    rows += [(100, [1.0] * 6, None), (1000, None, 0), (1050, [], 0), (1100, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0), (1150, [float("nan")] * 6, 0)]
    rows += [(None, [1.0] * 6, 0), (2000, [1.0, 2.0], 0), (2050, [2.0, 1.0], 0), (2051, [1.0, 1.0], 3), (3000, [0.0] * 6, 0)]
    return rows


def sql_table(rows):
    connection = duckdb.connect()
    ids, vectors, labels = zip(*rows, strict=True) if rows else ((), (), ())
    embeddings = pa.table({"vec_id": pa.array(ids, pa.int64()), "embedding": pa.array(vectors, pa.list_(pa.float32())), "label": pa.array(labels, pa.int32())})
    connection.register("embeddings", embeddings)
    return connection


@pytest.mark.parametrize("sizes", [{}, {"block": 3, "shard": 40, "step": 1}, {"step": 100}])
def test_negatives_against_sql(spark, sizes):
    rows = labelled_rows()
    frame = spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit(1) for c in ("row", "place", "query_id", "anchor_id", "dim", "vector", "score")})
    moved = frame.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    found = negatives.hard_negatives(moved, "vec_id % 50 = 0", **sizes)
    assert differences(found, sql_table(rows), negatives.ORACLE) is None


def test_negatives_of_an_empty_table(spark):
    assert negatives.hard_negatives(spark.createDataFrame([], VECTORS), "vec_id % 50 = 0").collect() == []
    alone = spark.createDataFrame([(50, [1.0], 1), (51, [1.0], 2)], VECTORS)
    assert negatives.hard_negatives(alone, "vec_id % 50 = 0").collect() == []  # no positive opens a window


def test_windows_hold_what_the_shares_say():
    for score in range(-40, 41):
        low, high = negatives.window(score, 50, 95)
        wanted = [n for n in range(-60, 61) if 50 * score <= 100 * n <= 95 * score]
        assert [n for n in range(-60, 61) if low <= n <= high] == wanted


def test_bounds_never_lose_a_candidate():
    rng = np.random.default_rng(0)
    for _ in range(30):
        columns = rng.integers(-50, 50, (12, 200)).astype(float)
        anchor = rng.integers(-50, 50, 12).astype(float)
        exact = anchor @ columns
        live, scores = negatives.scan(anchor, columns, columns.min(axis=1), columns.max(axis=1), np.arange(200), negatives.among_best(5), 2)
        assert (scores == exact[live]).all() and set(np.argsort(-exact)[:5]) <= set(live)
        spans = [(int(exact.mean()), int(exact.max() * 0.6)), (0, 40)]
        live, scores = negatives.scan(anchor, columns, columns.min(axis=1), columns.max(axis=1), np.arange(200), negatives.within(spans, 3), 2)
        for low, high in spans:
            inside = np.sort(exact[(exact >= low) & (exact <= high)])[::-1][:3]
            assert list(np.sort(scores[(scores >= low) & (scores <= high)])[::-1][:3]) == list(inside)


def test_bounds_shrink_the_candidates():
    """On vectors with a few heavy dimensions most candidates go before the last dimension is read."""
    rng = np.random.default_rng(1)
    columns = rng.integers(-1000, 1000, (16, 4000)) * np.array([100, 50, 20] + [1] * 13)[:, None].astype(float)
    anchor, seen = columns[:, 7], []

    def watched(lower, upper):
        seen.append(len(lower))
        return negatives.among_best(5)(lower, upper)

    negatives.scan(anchor, columns, columns.min(axis=1), columns.max(axis=1), np.arange(4000), watched, 2)
    assert seen[1] < 1500 and seen[-1] < 50


@pytest.mark.parametrize("large", [3.0e5, 3.0e6])
def test_negatives_of_large_values_are_exact(spark, large):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.integers(-9, 9, 4) * large / 9 + rng.integers(0, 99, 4)], i % 3) for i in range(120)]
    found = defaultdict(list)
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    for r in negatives.hard_negatives(frame, "vec_id % 50 = 0").orderBy("rank").collect():
        found[r.anchor_id, r.positive_id].append((r.positive_score, r.negative_id, r.negative_score))
    whole = {i: ([int(np.floor(256 * x)) for x in v], y) for i, v, y in rows}
    dot = lambda a, b: sum(x * y for x, y in zip(whole[a][0], whole[b][0]))
    expected = {}
    for a in (0, 50, 100):
        for s, p in sorted((-dot(a, x), x) for x in whole if x != a and whole[x][1] == whole[a][1])[:5]:
            inside = sorted((-dot(a, x), x) for x in whole if whole[x][1] != whole[a][1] and 50 * -s <= 100 * dot(a, x) <= 95 * -s)
            expected[a, p] = [(-s, x, -n) for n, x in inside[:3]]
    assert dict(found) == {k: v for k, v in expected.items() if v}


@pytest.mark.parametrize("sizes", [{}, {"block": 3, "shard": 40, "fan_in": 2}])
def test_exact_search_with_repeated_ids_against_sql(spark, sizes):
    rows = [(0, [1.0, 0.0], 0), (1, [5.0, 0.0], 0), (1, [9.0, 0.0], 0), (1, [9.0, 0.0], 1), (50, [2.0, 1.0], 0), (50, [-2.0, 1.0], 0), (None, [3.0, 3.0], 0)]
    rows += labelled_rows()
    found = topk.top_k(spark.createDataFrame(rows, VECTORS), "vec_id % 50 = 0", **sizes)
    assert differences(found, sql_table(rows), topk.ORACLE) is None
    best = found.where("query_id = 0").collect()
    assert 256 * 256 * 9 in {r.score for r in best}


def test_exact_search_beyond_64_bits(spark):
    kind = "vec_id bigint, embedding array<double>"
    # -2**70 would overflow, but is never among the best
    rows = [(0, [2.0**30, 1.0]), (1, [-(2.0**30), 0.0]), (2, [0.0, 3.0]), (3, [2.0**14, 1.0])]
    found = topk.top_k(spark.createDataFrame(rows, kind), "vec_id = 0", top=2).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in found] == [(3, 2**60 + 2**16), (2, 3 * 2**16)]
    with pytest.raises(Exception, match="OverflowError"):
        topk.top_k(spark.createDataFrame([(0, [1e18, 0.0]), (1, [1e18, 0.0])], kind), "vec_id = 0").collect()


def test_odd_vectors_have_hard_negatives(spark):
    rows = [tuple(r) for r in odd_vectors(spark).collect()]
    found = negatives.hard_negatives(odd_vectors(spark).withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))), "vec_id % 50 = 0")
    assert differences(found, sql_table(rows), negatives.ORACLE) is None
