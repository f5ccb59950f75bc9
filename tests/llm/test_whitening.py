"""Whitening against a dense eigendecomposition in numpy."""

import sys
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
from test_tables import SF, VECTORS, odd_vectors

from tidemark.llm import whitening
from tidemark.llm.queries import QUERIES


def plain(vectors, components=16):
    """(n, deviation and whitened components of each vector, shares of the trace), all dense."""
    whole = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors], np.int64)
    distinct = np.unique(whole, axis=0)
    n, sums = len(distinct), distinct.sum(axis=0)
    centred = distinct - sums / n
    values, turn = np.linalg.eigh(centred.T @ centred / n)
    values, turn = values[::-1][:components], turn[:, ::-1][:, :components]
    deviations = [sum((n * int(x) - int(s)) ** 2 for x, s in zip(row, sums)) for row in whole]
    return n, deviations, (whole - sums / n) @ turn / np.sqrt(values), values / (centred**2).sum() * n


def compared(found, ids, vectors, components=16):
    n, deviations, expected, shares = plain(vectors, components)
    place = {i: k for k, i in enumerate(ids)}
    got, seen = np.zeros(expected.shape), defaultdict(int)
    for r in found:
        got[place[r.vec_id], r.component - 1] = r.whitened
        seen[r.vec_id] += 1
        assert (r.n, r.deviation) == (n, deviations[place[r.vec_id]])
        assert r.explained == pytest.approx(shares[r.component - 1], rel=1e-9) and r.identity_error < 1e-10
    assert set(seen.values()) == {expected.shape[1]} and set(seen) == set(ids)
    signs = np.sign((got * expected).sum(axis=0))
    assert np.abs(got * signs - expected).max() < 1e-7


def test_whitening_of_the_given_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    compared(QUERIES["op12_embedding_whitening"](spark, SF).collect(), [r.vec_id for r in rows], [r.embedding for r in rows])


def test_whitening_of_odd_rows(spark):
    frame = odd_vectors(spark).withColumns({c: F.lit(1) for c in ("x", "dim", "n", "component", "vector", "cell")})
    found = whitening.whiten(frame).collect()
    six = [r for r in found if r.vec_id not in (2000, 2050)]
    valid = [(r.vec_id, r.embedding) for r in odd_vectors(spark).collect() if r.embedding and len(r.embedding) == 6 and all(x is not None and np.isfinite(x) for x in r.embedding)]
    assert sum(i is None for i, _ in valid) == 1 and sum(i == 0 for i, _ in valid) == 2
    assert len(six) == 6 * len(valid)  # repeated rows and rows without an id are whitened each
    ids = {i: v for i, v in valid}
    compared(list({(r.vec_id, r.component): r for r in six}.values()), list(ids), list(ids.values()), 6)
    # two vectors differ along one direction only
    assert sorted((r.vec_id, r.component) for r in found if r.vec_id in (2000, 2050)) == [(2000, 1), (2050, 1)]
    assert {round(abs(r.whitened), 9) for r in found if r.vec_id in (2000, 2050)} == {1.0}


def test_whitening_without_variance(spark):
    assert whitening.whiten(spark.createDataFrame([], VECTORS)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)], VECTORS)).collect() == []


def test_deviations_are_exact_or_refused():
    x = np.array([[1_000_000 + 3, 1_000_000], [1_000_000 - 1, 1_000_000 + 2]], np.int64)
    centre = whitening.Centre(2, tuple(int(s) for s in x.sum(axis=0)))
    assert list(centre.deviations(x)) == [20, 20]
    far = np.array([[10**9], [-(10**9)]], np.int64)
    assert list(whitening.Centre(2, (0,)).deviations(far)) == [4 * 10**18] * 2
    with pytest.raises(OverflowError):
        whitening.Centre(4, (0,)).deviations(far)
    with pytest.raises(OverflowError):
        whitening.Centre(3, (0,)).deviations(np.array([[2**61]], np.int64))


@pytest.mark.parametrize("spectrum", ["flat", "steep", "clustered", "few"])
def test_leading_eigenvectors(spectrum):
    rng = np.random.default_rng(4)
    dim = 90
    values = {
        "flat": np.linspace(1.0, 0.9, dim),
        "steep": 0.7 ** np.arange(dim),
        "clustered": np.concatenate([[50, 49, 48], 1 + 0.001 * rng.random(dim - 3)]),
        "few": np.concatenate([[9, 5, 4], np.zeros(dim - 3)]),
    }[spectrum]
    turn, _ = np.linalg.qr(rng.normal(size=(dim, dim)))
    v = (turn * values) @ turn.T
    order = np.argsort(-values)
    passes = []

    def product(q):
        passes.append(q.shape[1])
        return v @ q

    found, vectors = whitening.leading(product, dim, 3 if spectrum != "flat" else 16)
    k = len(found)
    assert np.allclose(found, values[order][:k], rtol=1e-11, atol=1e-11)
    assert np.abs(np.abs(np.diag(vectors.T @ turn[:, order[:k]])) - 1).max() < 1e-9
    assert len(passes) < 150 and max(passes) < dim  # the block stays thin


def test_a_missed_direction_joins_the_block(monkeypatch):
    """The first block is orthogonal to the leading eigenvector; the certificate finds that."""
    dim = 60
    values = np.concatenate([[3.0], np.linspace(1.0, 0.1, dim - 1)])
    real = np.random.default_rng

    class Blind:
        def __init__(self, seed):
            self.inner, self.calls = real(seed), 0

        def normal(self, size):
            self.calls += 1
            found = self.inner.normal(size=size)
            if self.calls <= 2:
                found[0] = 0
            return found

    monkeypatch.setattr(whitening.np.random, "default_rng", Blind)
    found, _ = whitening.leading(lambda q: values[:, None] * q, dim, 3, guard=4)
    assert np.allclose(found, values[:3], rtol=1e-10)
