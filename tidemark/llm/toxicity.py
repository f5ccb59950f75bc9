"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Words are runs of ASCII letters, digits and bytes above ASCII, with A-Z lower-cased. A document's features
are the set of its words, of its pairs of neighbours and of its pairs with one word between, each hashed to
``2**bits`` places. Training keeps a rate for each coordinate and drives weights to exact zero by the L1
term, so that a model is a short list of weights, which is sent to every task.

Training rows are a sample bounded by class: toxic rows are kept up to half of the bound, others fill the rest.
The bias is put right by the log of the classes' rates, so that scores stay probabilities of the whole table.
One task learns from the sample, because weights averaged over shards lose what is rare in each. The L1 term is
the one of ``L1`` with the least log loss on left-out thirds of the sample, where the bias is put right too.

Defined cases: a null or empty text has no words and gets the bias alone; repeated rows are scored each; an
empty table gives an empty result; without labelled rows every score is the prior of one in four.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import column
from tidemark.llm.common import bounded_ids, fresh, kept, pieces, table, utf8

BITS = 20
SAMPLE_ROWS = 20_000
FOLDS = 5
#: L1 terms to choose from, and the left-out parts they are judged by.
L1 = (8.0, 4.0, 2.0)
PARTS = 3

_LOWER = np.zeros(256, np.uint8)
for _low, _high in ((48, 57), (97, 122), (128, 255)):
    _LOWER[_low : _high + 1] = np.arange(_low, _high + 1)
_LOWER[65:91] = np.arange(97, 123)

_BASE = 0x9E3779B97F4A7C15
_ODD = [np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def _powers(base: int, n: int) -> np.ndarray:
    found = np.full(n, base, np.uint64)
    found[0] = 1
    return np.multiply.accumulate(found)


_UP = _powers(_BASE, (1 << 20) + 1)
_DOWN = _powers(pow(_BASE, -1, 1 << 64), (1 << 20) + 1)


def features(data: np.ndarray, starts: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Place in ``starts`` and feature of every n-gram of the rows that begin at ``starts``; repeats included."""
    code = _LOWER[data]
    inside = code > 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    held = starts[(starts < len(data)) & (starts >= 0)]
    begins[held] = inside[held]
    at = np.flatnonzero(begins)
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # Bytes outside words are zero, so the sum up to the next word is the word's own.
    words = np.add.reduceat(code * _UP[: len(code)], at) * _DOWN[at]
    row = np.searchsorted(starts, at, "right") - 1
    shift = np.uint64(64 - bits)

    def place(x: np.ndarray) -> np.ndarray:
        x = (x ^ (x >> np.uint64(29))) * _ODD[3]
        return (x >> shift).astype(np.int64)

    rows, found = [row], [place(words * _ODD[0])]
    for gap in (1, 2):
        same = row[gap:] == row[:-gap]
        rows.append(row[gap:][same])
        found.append(place((words[:-gap] * _ODD[gap] + (words[gap:] ^ (words[gap:] >> np.uint64(31))) * _ODD[3])[same]))
    return np.concatenate(rows), np.concatenate(found)


@dataclass(frozen=True)
class Model:
    """Places with a weight, their weights, and the bias."""

    bits: int
    places: np.ndarray
    weights: np.ndarray
    bias: float


def _features_of(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds, data = utf8(batch.column("text"))
            sets: list[list[np.ndarray]] = [[] for _ in range(batch.num_rows)]
            for part, starts, rows in pieces(bounds, data):
                row, found = features(part, starts, bits)
                both = np.unique((row << bits) | found)
                cuts = np.searchsorted(both, np.arange(len(starts) + 1) << bits)
                for i, r in enumerate(rows):
                    sets[r].append((both[cuts[i] : cuts[i + 1]] & ((1 << bits) - 1)).astype(np.int32))
            packed = [np.unique(np.concatenate(x)).tobytes() if x else b"" for x in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("label"), pa.array(packed, pa.binary())], ["key", "label", "places"]
            )

    return run


def train(sets: list[np.ndarray], labels: np.ndarray, bits: int, epochs: int, alpha: float, beta: float, l1: float, l2: float) -> Model:
    """FTRL-proximal in the order given."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    bias_z = bias_n = 0.0
    for _ in range(epochs):
        for at, label in zip(sets, labels, strict=True):
            zs, ns = z[at], n[at]
            w = np.where(np.abs(zs) > l1, -(zs - np.sign(zs) * l1) / ((beta + np.sqrt(ns)) / alpha + l2), 0.0)
            bias = -bias_z / ((beta + np.sqrt(bias_n)) / alpha)
            g = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -35, 35))) - label
            z[at] = zs + g - (np.sqrt(ns + g * g) - np.sqrt(ns)) / alpha * w
            n[at] = ns + g * g
            bias_z += g - (np.sqrt(bias_n + g * g) - np.sqrt(bias_n)) / alpha * bias
            bias_n += g * g
    places = np.flatnonzero(np.abs(z) > l1)
    weights = -(z[places] - np.sign(z[places]) * l1) / ((beta + np.sqrt(n[places])) / alpha + l2)
    return Model(bits, places, weights, float(-bias_z / ((beta + np.sqrt(bias_n)) / alpha)))


def log_loss(sets: list[np.ndarray], labels: np.ndarray, model: Model, odds: float) -> float:
    """Sum over the rows, each class at its share of the whole table."""
    dense = np.zeros(1 << model.bits)
    dense[model.places] = model.weights
    sums = np.array([dense[at].sum() for at in sets]) + model.bias - odds
    return float((np.logaddexp(0, np.where(labels == 1, -sums, sums)) * np.where(labels == 1, np.exp(-odds), 1.0)).sum())


def fit(
    labelled: DataFrame,
    bits: int = BITS,
    epochs: int = 4,
    alpha: float = 0.5,
    beta: float = 1.0,
    l1: tuple[float, ...] = L1,
    l2: float = 0.1,
    odds: float = 0.0,
) -> Model:
    """Learns from ``key``, ``text`` and ``label`` (0 or 1). ``labelled`` is a sample that the caller has bounded.

    ``odds`` is the log of how much more of the rows with label 1 than of the others are in the sample.
    """
    sets = kept(
        labelled.select("key", "text", F.col("label").cast("int").alias("label"))
        .where("label is not null")
        .mapInArrow(_features_of(bits), "key bigint, label int, places binary"),
        "toxicity-features",
    )
    total, positive = sets.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not 0 < positive < total:
        share = (positive + 0.5) / (total + 2)
        return Model(bits, np.zeros(0, np.int64), np.zeros(0), float(np.log(share / (1 - share))))

    def ready(rows: pd.DataFrame) -> tuple[list[np.ndarray], np.ndarray]:
        rows = rows.sort_values(["key", "places"], kind="stable")
        return [np.frombuffer(x, np.int32) for x in rows["places"]], rows["label"].to_numpy()

    def judge(rows: pd.DataFrame) -> pd.DataFrame:
        out = rows["part"] == rows["run"]
        seen, left = ready(rows[~out]), ready(rows[out])
        losses = [log_loss(*left, train(*seen, bits, epochs, alpha, beta, x, l2), odds) for x in l1]
        return pd.DataFrame({"l1": l1, "loss": losses, "run": rows["run"].iloc[0]})

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        found = train(*ready(rows), bits, epochs, alpha, beta, best, l2)
        return pd.DataFrame({"places": [found.places.tobytes()], "weights": [found.weights.tobytes()], "bias": [found.bias]})

    runs = sets.withColumn("part", F.pmod(F.xxhash64("key", F.lit("part")), F.lit(PARTS)).cast("int"))
    runs = runs.withColumn("run", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    judged = sorted((r.l1, r.run, r.loss) for r in runs.groupBy("run").applyInPandas(judge, "l1 double, loss double, run int").collect())  # a few a run
    best = min(l1, key=lambda x: (sum(loss for y, _, loss in judged if y == x), -x))
    row = sets.groupBy().applyInPandas(learn, "places binary, weights binary, bias double").first()
    return Model(bits, np.frombuffer(row.places, np.int64), np.frombuffer(row.weights, np.float64), row.bias - odds)


def score(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of every row, ``score`` (0 to 1) and ``predicted`` (1 if the score is 0.5 or more)."""
    bits, places, weights, bias = model.bits, model.places, model.weights, model.bias
    name = fresh(docs.select(*[column(c) for c in keep]), "text_of")
    rows = docs.select(*[column(c) for c in keep], column(text).cast("string").alias(name))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1]) + ", score double, predicted int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.zeros(1 << bits)
        dense[places] = weights
        for batch in batches:
            bounds, data = utf8(batch.column(batch.num_columns - 1))
            hits = [np.zeros(0, np.int64)]
            for part, starts, of in pieces(bounds, data):
                row, found = features(part, starts, bits)
                weighty = np.flatnonzero(dense[found])
                hits.append((of[row[weighty]] << bits) | found[weighty])
            both = np.unique(np.concatenate(hits))  # a feature counts once in a document
            sums = np.bincount(both >> bits, dense[both & ((1 << bits) - 1)], batch.num_rows) + bias
            scores = 1 / (1 + np.exp(-np.clip(sums, -35, 35)))
            arrays = [batch.column(i) for i in range(batch.num_columns - 1)]
            arrays += [pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names[:-1], "score", "predicted"])

    return rows.mapInArrow(run, schema)


def training_sample(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_ROWS) -> tuple[DataFrame, float]:
    """Labelled documents outside the held-out fold, ``most`` at the most, and ``odds`` for ``fit``. Contradicting labels count as 1.

    Rows with label 1 are all kept as long as they fill at most half of the sample, or others do not fill the other half.
    """
    ids = labels.groupBy("doc_id").agg(F.max("toxic").alias("label")).where("label is not null and doc_id is not null")
    ids = kept(ids.where(F.crc32(F.col("doc_id").cast("string")) % FOLDS != 0), "toxicity-labels")
    positive, others = ids.agg(F.count_if(F.col("label") == 1), F.count_if(F.col("label") != 1)).first()
    of_positive = min(positive, max(most // 2, most - others))
    of_others = min(others, most - of_positive)
    odds = float(np.log(of_positive / positive) - np.log(of_others / others)) if positive and others else 0.0
    drawn = bounded_ids(ids.where("label = 1"), "doc_id", of_positive).unionByName(bounded_ids(ids.where("label <> 1"), "doc_id", of_others))
    # Bounded by ``most`` rows of two numbers, so it may go to every task.
    rows = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    return rows.select(F.col("doc_id").cast("bigint").alias("key"), "text", "label"), odds


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score, from labels of the training folds."""
    docs = table(spark, sf_dir, "documents")
    sample, odds = training_sample(docs, table(spark, sf_dir, "labels"))
    model = fit(sample, odds=odds)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0, F.lit(False))
    return score(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")
