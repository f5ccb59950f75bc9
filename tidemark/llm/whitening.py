"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Entries become integers, floor(scale * c) + shift. The fit list holds each distinct vector once; its covariance V
(divisor n) is never built. All that is asked of the data are products V Q with a thin block Q: each task
centres its rows exactly (as integers, but for the mean's fraction), multiplies them by the block and back, and
the partial blocks are summed, which shuffles no more than the block's cells from each task.

1. A few Lanczos steps bound the spectrum from both sides.
2. A block with ``guard`` more columns than components goes through cycles. The Chebyshev recurrence, one product
   for each degree, damps the eigenvalues from the lower bound up to the block's smallest Ritz value and so lifts
   the wanted ones; QR makes the block orthonormal again; Rayleigh-Ritz turns it into approximate eigenvectors.
3. The components are certified when all their residuals are at rounding, and Lanczos steps on what the block
   leaves out find no eigenvalue above the smallest component's. A larger one found there joins the block.

Defined cases: rows whose vector is null, empty or holds a null or non-finite entry are dropped; rows without an
id, and repeated rows, are whitened each; vectors of different lengths are spaces of their own, each with its own
fit list; components with a variance at rounding (as when all vectors are equal) cannot be whitened and are left
out; an empty table gives an empty result. An entry or deviation that no bigint holds raises an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import column
from tidemark.llm.common import kept, table

COMPONENTS = 16
GUARD = 16
DEGREE = 10
LANCZOS = 10
SCALE = 64
SHIFT = 1_000_000
#: Residuals of certified components, and variances that count as none, in parts of the largest eigenvalue.
TOLERANCE = 1e-13
NOTHING = 1e-12
MOST_CYCLES = 40

#: V times a block.
Product = Callable[[np.ndarray], np.ndarray]


def whole_vectors(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """(``vec_id``, ``dim``, ``x``: 64-bit integers as bytes) of every row with only finite entries."""
    rows = vectors.select(column(vec_id).alias("vec_id"), column(vector).cast("array<double>").alias("vector"))
    rows = rows.where("vector is not null and size(vector) > 0")
    rows = rows.where("coalesce(forall(vector, c -> c is not null and not isnan(c) and abs(c) < double('Infinity')), false)")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("vector")
            bounds = values.offsets.to_numpy()
            whole = np.floor(scale * values.values.to_numpy(zero_copy_only=False).astype("<f8"))
            if np.abs(whole).max(initial=0) >= 2.0**62:
                raise OverflowError(f"an entry times {scale} is beyond 64 bits")
            whole = whole.astype("<i8") + shift
            packed = [whole[a:b].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)]
            arrays = [batch.column("vec_id"), pa.array(np.diff(bounds), pa.int32()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "dim", "x"])

    return rows.mapInArrow(run, f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, dim int, x binary")


def block(values: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(values.to_pylist()), "<i8").reshape(-1, dim)


@dataclass(frozen=True)
class Centre:
    """The fit list's size and sums; ``n * base + rest`` is the sum of each dimension, with 0 <= rest < n."""

    n: int
    sums: tuple[int, ...]

    @property
    def base(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        return np.array([s % self.n for s in self.sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n: the whole part is subtracted exactly, so only the fraction is rounded."""
        return (x - self.base).astype(np.float64) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """Sum over dimensions of (n * x - S)**2, exact or refused."""
        off = x - self.base
        largest = self.n * (int(np.abs(off).max(initial=0)) + 1)
        if largest * largest * x.shape[1] < 2**63:
            wide = self.n * off - self.rest
            return (wide * wide).sum(axis=1)
        rest = [int(r) for r in self.rest]
        found = [sum((self.n * int(v) - r) ** 2 for v, r in zip(row, rest, strict=True)) for row in off]
        if max(found, default=0) >= 2**63:
            raise OverflowError("a deviation is beyond 64 bits")
        return np.array(found, np.int64)


def summed(fit: DataFrame, dim: int, shape: tuple[int, ...], part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows of ``part(rows)``, a block of that shape; only its cells reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            total += part(block(batch.column(0), dim))
        cells = np.arange(total.size, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total.ravel())], ["cell", "value"])

    cells = fit.select("x").mapInArrow(run, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    out = np.zeros(shape)
    for row in cells.collect():  # as many as the block has cells
        out.flat[row.cell] = row.value
    return out


def sums_of(fit: DataFrame, dim: int) -> Centre:
    """Size and exact sums of the fit list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = block(batch.column(0), dim)
            # Sums of halves of 32 bits cannot overflow within a batch.
            low, high = (x & 0xFFFFFFFF).sum(axis=0), (x >> 32).sum(axis=0)
            cells = [pa.array(np.arange(dim, dtype=np.int32)), pa.array(low), pa.array(high), pa.array(np.full(dim, len(x), np.int64))]
            yield pa.RecordBatch.from_arrays(cells, ["cell", "low", "high", "n"])

    parts = fit.select("x").mapInArrow(run, "cell int, low bigint, high bigint, n bigint")
    wide = [F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("low", "high", "n")]
    rows = {r.cell: r for r in parts.groupBy("cell").agg(*wide).collect()}  # one for each dimension
    return Centre(int(rows[0].n), tuple(int(rows[j].low) + (int(rows[j].high) << 32) for j in range(dim)))


def lanczos(product: Product, start: np.ndarray, steps: int, leave_out: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values, their residuals and Ritz vectors, orthogonal to the columns of ``leave_out``."""

    def apart(v: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
        for _ in range(2):
            if leave_out is not None:
                v = v - leave_out @ (leave_out.T @ v)
            for b in basis:
                v = v - b * (b @ v)
        return v

    basis: list[np.ndarray] = []
    alpha, beta = [], []
    v = apart(start, basis)
    length = float(np.linalg.norm(v))
    while len(basis) < steps and length > 0:
        v = v / length
        w = product(v[:, None])[:, 0]
        basis.append(v)
        alpha.append(float(v @ w))
        v = apart(w, basis)
        length = float(np.linalg.norm(v))
        if length <= 1e-13 * max(1e-300, abs(max(alpha, key=abs))):
            length = 0.0
        beta.append(length)
    if not basis:
        return np.zeros(0), np.zeros(0), np.zeros((len(start), 0))
    values, vectors = np.linalg.eigh(np.diag(alpha) + np.diag(beta[:-1], 1) + np.diag(beta[:-1], -1))
    return values, np.abs(vectors[-1]) * beta[-1], np.stack(basis, axis=1) @ vectors


def filtered(product: Product, q: np.ndarray, vq: np.ndarray, degree: int, low: float, high: float, top: float) -> np.ndarray:
    """The block under the Chebyshev polynomial that is small on [low, high], scaled to 1 at ``top``; ``vq`` is V q."""
    half, middle = (high - low) / 2, (high + low) / 2
    first = half / (top - middle)
    scale, before, now = first, q, (vq - middle * q) * (first / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - scale)
        before, now = now, (product(now) - middle * now) * (2 * following / half) - (scale * following) * before
        scale = following
    return now


def rayleigh_ritz(product: Product, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values in falling order, their vectors in the span of ``y``, and V times these."""
    q, _ = np.linalg.qr(y)
    vq = product(q)
    small = q.T @ vq
    values, turn = np.linalg.eigh((small + small.T) / 2)
    turn = turn[:, ::-1]
    return values[::-1], q @ turn, vq @ turn


def leading(product: Product, dim: int, components: int, guard: int = GUARD, degree: int = DEGREE, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues in falling order and their vectors, certified."""
    rng = np.random.default_rng(seed)
    wanted, width = min(components, dim), min(components + guard, dim)
    values, residuals, _ = lanczos(product, rng.normal(size=dim), min(LANCZOS, dim))
    low = max(0.0, float(values[0] - residuals[0]))
    found, q, vq = rayleigh_ritz(product, rng.normal(size=(dim, width)))
    best = np.inf
    for _ in range(MOST_CYCLES):
        off = float(np.linalg.norm(vq[:, :wanted] - q[:, :wanted] * found[:wanted], axis=0).max())
        settled = off <= TOLERANCE * found[0] or (off <= 1e3 * TOLERANCE * found[0] and off > best / 2)
        if found[0] <= 0 or settled:
            if width == dim or found[0] <= 0:
                return found[:wanted], q[:, :wanted]
            more, _, rest = lanczos(product, rng.normal(size=dim), min(LANCZOS, dim - width), q)
            if not len(more) or more[-1] <= found[wanted - 1]:
                return found[:wanted], q[:, :wanted]
            # The block missed a direction: it takes the place of the least one.
            q, best = np.column_stack([q[:, :-1], rest[:, -1]]), np.inf
            found, q, vq = rayleigh_ritz(product, q)
            continue
        best = min(best, off)
        cut = max(float(found[-1]), low + 1e-12 * float(found[0]))
        y = filtered(product, q, vq, degree, low, cut, float(found[0])) if cut < found[0] else vq
        found, q, vq = rayleigh_ritz(product, y)
        low = min(low, float(found[-1]))
    raise ArithmeticError(f"components are not certified after {MOST_CYCLES} cycles; largest residual {off:.3g} of {found[0]:.3g}")


@dataclass(frozen=True)
class Whitening:
    """A fitted space: dividing projections on ``vectors`` by the roots of ``values`` whitens the fit list."""

    centre: Centre
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    def apply(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ self.vectors / np.sqrt(self.values)


def fit(distinct: DataFrame, dim: int, components: int = COMPONENTS, guard: int = GUARD, degree: int = DEGREE) -> Whitening:
    """Learns from ``x`` of ``distinct``, which is stored and read once for each product."""
    centre = sums_of(distinct, dim)
    n = centre.n

    def product(q: np.ndarray) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            c = centre.centred(x)
            return c.T @ (c @ q)

        return summed(distinct, dim, q.shape, part) / n

    trace = float((summed(distinct, dim, (dim,), lambda x: (centre.centred(x) ** 2).sum(axis=0)) / n).sum())
    values, vectors = leading(product, dim, components, guard, degree) if trace > 0 else (np.zeros(0), np.zeros((dim, 0)))
    holds = values > NOTHING * max(trace, 0.0)
    values, vectors = values[holds], vectors[:, holds]
    # Either sign is an eigenvector; the largest entry's is made positive.
    if len(values):
        vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])
    found = Whitening(centre, values, vectors, trace, 0.0)
    if not len(values):
        return found

    k = len(values)

    def moments(x: np.ndarray) -> np.ndarray:
        w = found.apply(x)
        return np.vstack([w.T @ w, w.sum(axis=0)])

    both = summed(distinct, dim, (k + 1, k), moments) / n
    covariance = both[:-1] - np.outer(both[-1], both[-1])
    return Whitening(centre, values, vectors, trace, float(np.abs(covariance - np.eye(k)).max()))


def whiten(
    vectors: DataFrame, components: int = COMPONENTS, guard: int = GUARD, degree: int = DEGREE, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE, shift: int = SHIFT
) -> DataFrame:
    """(``vec_id``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``) of every row and component."""
    rows = kept(whole_vectors(vectors, vec_id, vector, scale, shift), "whole-vectors")
    distinct = kept(rows.select("dim", "x").distinct(), "fit-list")
    kind = rows.schema["vec_id"].dataType.simpleString()
    out = None
    # One space for each length of vectors; a table of embeddings has one.
    for dim in [r[0] for r in distinct.select("dim").distinct().orderBy("dim").collect()]:
        space = fit(distinct.where(F.col("dim") == dim), dim, components, guard, degree)
        found = rows.where(F.col("dim") == dim).mapInArrow(_whitened(space, dim), _schema(kind))
        out = found if out is None else out.unionByName(found)
    return out if out is not None else vectors.sparkSession.createDataFrame([], _schema(kind))


def _schema(kind: str) -> str:
    return f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def _whitened(space: Whitening, dim: int):
    k = len(space.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = block(batch.column("x"), dim)
            place = np.repeat(np.arange(len(x)), k)
            arrays = [
                batch.column("vec_id").take(pa.array(place)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(place), space.centre.n, np.int64)),
                pa.array(space.centre.deviations(x)[place]),
                pa.array(space.apply(x).ravel()),
                pa.array(np.tile(space.values / space.trace if k else np.zeros(0), len(x))),
                pa.array(np.full(len(place), space.identity_error)),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return run


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen whitened components of every embedding."""
    return whiten(table(spark, sf_dir, "embeddings"))
