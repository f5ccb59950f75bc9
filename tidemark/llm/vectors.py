"""Vectors in binary form, and products of blocks of queries with shards of candidates."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import column


def packed(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", zero: bool = True, extra: Mapping[str, Column] | None = None
) -> DataFrame:
    """(``vec_id``, ``dim``, ``vector``: doubles as bytes, ``extra`` columns) of all rows with an id and only finite components.

    Vectors of zeros are left out unless ``zero``. Exact copies of a row count once; other rows may share an id.
    """
    names = list(extra or {})
    more = [value.alias(name) for name, value in (extra or {}).items()]
    whole = vectors.select(column(vec_id).cast("bigint").alias("vec_id"), column(vector).cast("array<double>").alias("vector"), *more)
    whole = whole.where("vec_id is not null and vector is not null and size(vector) > 0")
    # Comparisons with null give null, so a null component fails as NaN and the infinities do.
    whole = whole.where("coalesce(forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')), false)")
    if not zero:
        whole = whole.where("exists(vector, x -> x <> 0)")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("vector")
            bounds = values.offsets.to_numpy()
            flat = values.values.to_numpy(zero_copy_only=False).astype("<f8")
            rows = [flat[a:b].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)]
            dims = pa.array(np.diff(bounds), pa.int32())
            arrays = [batch.column("vec_id"), dims, pa.array(rows, pa.binary()), *(batch.column(name) for name in names)]
            yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "dim", "vector", *names])

    kinds = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in whole.schema[2:])
    return whole.distinct().mapInArrow(run, "vec_id bigint, dim int, vector binary" + kinds)


def matrix(column_of: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column_of), "<f8").reshape(len(column_of), -1)


def integers(vectors: np.ndarray, scale: int, most: int) -> np.ndarray:
    """floor(scale * x) in a type whose products and sums with numbers up to ``most`` are exact."""
    whole = np.floor(scale * vectors)
    largest = max(float(np.abs(whole).max(initial=0)), 1.0) * max(most, 1) * max(vectors.shape[1], 1)
    if largest < 2**53:
        return whole
    return whole.astype(np.int64) if largest < 2**63 else whole_numbers(whole)


def whole_numbers(values: np.ndarray) -> np.ndarray:
    """Python's integers, which have no largest one."""
    return np.array([int(x) for x in values.ravel()], object).reshape(values.shape)


def kth(values: np.ndarray, k: int):
    """The k-th largest."""
    return sorted(values)[-k] if values.dtype == object else np.partition(values, len(values) - k)[len(values) - k]


def tiled(
    queries: DataFrame,
    candidates: DataFrame,
    sizes: DataFrame | None,
    keys: list[str],
    block: int,
    shard: int,
    best: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
    schema: str,
    totals: tuple[int, int] | None = None,
) -> DataFrame:
    """``best(queries, candidates)`` for every pair of a block of queries and a shard of candidates that agree in ``keys``.

    Blocks hold about ``block`` queries and shards about ``shard`` candidates, dealt by hash, so every task's
    memory is bounded however many there are of either. ``sizes`` gives (``keys``, ``nq``, ``nc``); with
    ``totals`` these are the same for all keys.
    """
    if totals is not None:
        queries = queries.withColumns({"nq": F.lit(totals[0]), "nc": F.lit(totals[1])})
        candidates = candidates.withColumns({"nq": F.lit(totals[0]), "nc": F.lit(totals[1])})
    else:
        queries, candidates = queries.join(sizes, keys), candidates.join(sizes, keys)
    blocks, shards = F.ceil(F.col("nq") / block).cast("int"), F.ceil(F.col("nc") / shard).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1))
    own = lambda n, name: F.pmod(F.xxhash64(name, F.lit(3)), F.greatest(n, F.lit(1))).cast("int")
    left = queries.withColumns({"block": own(blocks, "query_id"), "shard": every(shards)}).drop("nq", "nc")
    right = candidates.withColumns({"block": every(blocks), "shard": own(shards, "vec_id")}).drop("nq", "nc")
    by = [*keys, "block", "shard"]
    # Both may come from one table; columns of the same name must not be the same column.
    left = left.select(*[F.col(c).alias(c) for c in left.columns])
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(best, schema)
