"""Language identification: averaged hashed subword embeddings under a linear softmax.

Subwords are byte n-grams of two to four bytes within words and their edges, hashed to ``2**bits`` rows of an
embedding table. A text's vector is the mean over its subwords; a softmax over a linear layer gives the
languages. Both tables are trained by stochastic gradient descent in numpy, on a sample that is bounded for
each language. As mean and layer are linear, scoring adds up one row of class scores per subword.

Calibration: a fifth of the sample is left out of training; the temperature that makes it likeliest scales
the softmax. A text is rejected if its score is below the threshold: the ``reject_share`` quantile on the
left-out rows, and never above the middle of pure chance and one half.

Defined cases: a text that is null or has no letter gets ``und``, score 0 and is not accepted; repeated rows
are labelled each; an empty table gives an empty result; without a sample every text gets ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import column
from tidemark.llm.common import fresh, kept, pieces, table, utf8

BITS = 16
WIDTH = 16
PER_LANGUAGE = 1_000
#: Rows of all languages together that the learning task gets, as long as there are fewer languages than that.
SAMPLE_ROWS = 64_000
#: Languages whose row counts are sent to every task; the model itself has 2**BITS weights for each.
SENT_COUNTS = 10_000
BATCH = 16
REJECT_SHARE = 0.001
FOLDS, HELD_OUT = 3, 1
UNKNOWN = "und"

# Letters lower-cased, bytes above ASCII as they are, all else a space.
_LOWER = np.full(256, 32, np.uint8)
_LOWER[97:123] = np.arange(97, 123)
_LOWER[65:91] = np.arange(97, 123)
_LOWER[128:] = np.arange(128, 256)
_MIX = np.uint32(0x9E3779B1)


def subwords(data: np.ndarray, starts: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n: positions where an n-gram begins, and its row in the table."""
    code = _LOWER[data].astype(np.uint32)
    blank = code == 32
    ends = np.zeros(len(code) + 1, bool)
    ends[starts[starts <= len(code)]] = True  # an n-gram does not run into the next text
    value = code.copy()
    good = np.ones(len(code), bool)
    for n in (2, 3, 4):
        size = len(code) - n + 1
        if size <= 0:
            return
        value = (value[:size] << np.uint32(8)) | code[n - 1 :]
        good = good[:size] & ~ends[n - 1 : n - 1 + size]
        if n > 2:
            good &= ~blank[n - 2 : n - 2 + size]  # a space may only be at either edge
        use = good & ~(blank[:size] & blank[n - 1 :]) if n == 2 else good
        at = np.flatnonzero(use)
        hashed = (value[at] * _MIX) ^ np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)
        yield at, ((hashed * _MIX) >> np.uint32(32 - bits)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    """Class scores of each row of the table, already scaled by the temperature, and the threshold."""

    languages: tuple[str, ...]
    bits: int
    table: np.ndarray
    bias: np.ndarray
    threshold: float


def _counts_of(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds, data = utf8(batch.column("text"))
            counts: dict[int, np.ndarray] = {}
            packed = [b""] * batch.num_rows
            for part, starts, rows in pieces(bounds, data):
                found = [np.zeros(0, np.int64)]
                for at, gram in subwords(part, starts, bits):
                    found.append(((np.searchsorted(starts, at, "right") - 1) << bits) | gram)
                both, times = np.unique(np.concatenate(found), return_counts=True)
                cuts = np.searchsorted(both, np.arange(len(starts) + 1) << bits)
                for i, r in enumerate(rows):
                    held = counts.setdefault(r, np.zeros(1 << bits, np.float32)) if len(rows) == 1 else None
                    grams, n = both[cuts[i] : cuts[i + 1]] & ((1 << bits) - 1), times[cuts[i] : cuts[i + 1]]
                    if held is not None:
                        held[grams] += n
                        grams = np.flatnonzero(held)
                        n = held[grams]
                    packed[r] = np.stack([grams.astype(np.float32), n.astype(np.float32)]).tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("lang"), pa.array(packed, pa.binary())], ["key", "lang", "counts"]
            )

    return run


def train(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, classes: int, bits: int, width: int, epochs: int, rate: float, seed: int):
    """Embedding table, linear layer and bias, by gradient descent over small batches."""
    rng = np.random.default_rng(seed)
    embed = rng.uniform(-1 / width, 1 / width, (1 << bits, width)).astype(np.float32)
    layer, bias = np.zeros((width, classes), np.float32), np.zeros(classes, np.float32)
    share = np.bincount(target, minlength=classes)
    worth = (share.sum() / np.maximum(share, 1) / classes).astype(np.float32)
    steps, step = max(1, epochs * -(-len(rows) // BATCH)), 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for low in range(0, len(order), BATCH):
            picked = order[low : low + BATCH]
            grams = np.concatenate([rows[i][0] for i in picked])
            part = np.concatenate([rows[i][1] for i in picked])
            sizes = [len(rows[i][0]) for i in picked]
            cuts = np.cumsum([0, *sizes[:-1]])
            x = np.add.reduceat(embed[grams] * part[:, None], cuts)
            p = _softmax(x @ layer + bias)
            p[np.arange(len(picked)), target[picked]] -= 1
            p *= worth[target[picked]][:, None]
            now = rate * (1 - step / steps)
            back = p @ layer.T
            layer -= now * (x.T @ p) / len(picked)
            bias -= now * p.sum(0) / len(picked)
            np.subtract.at(embed, grams, now * np.repeat(back, sizes, axis=0) * part[:, None])
            step += 1
    return embed, layer, bias


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit(labelled: DataFrame, bits: int = BITS, width: int = WIDTH, epochs: int = 5, least_steps: int = 2_000, rate: float = 0.5, reject_share: float = REJECT_SHARE, seed: int = 7) -> Model:
    """Learns from ``key``, ``text``, ``lang``; the caller has bounded the rows of each language."""
    counts = kept(
        labelled.select("key", "text", "lang").mapInArrow(_counts_of(bits), "key bigint, lang string, counts binary"), "language-counts"
    )
    languages = tuple(r[0] for r in counts.select("lang").distinct().orderBy("lang").collect())  # one row a language
    if not languages:
        return Model((), bits, np.zeros((1 << bits, 0), np.float32), np.zeros(0), 1.0)

    def learn(sample: pd.DataFrame) -> pd.DataFrame:
        sample = sample.sort_values(["key", "lang"], kind="stable")
        rows, target, left_out = [], [], []
        for key, lang, packed in zip(sample["key"], sample["lang"], sample["counts"], strict=True):
            grams, n = np.frombuffer(packed, np.float32).reshape(2, -1)
            if len(grams):
                rows.append((grams.astype(np.int64), n / n.sum()))
                target.append(languages.index(lang))
                left_out.append(hash_of(key) % 5 == 0)
        target, left_out = np.array(target, np.int64), np.array(left_out, bool)
        mine = [r for r, out in zip(rows, left_out, strict=True) if not out]
        rounds = max(epochs, -(-least_steps * BATCH // max(1, len(mine))))  # few rows are gone over more often
        embed, layer, bias = train(mine, target[~left_out], len(languages), bits, width, rounds, rate, seed)
        scores = embed @ layer
        temperature, threshold = 1.0, 0.0
        if left_out.any():
            logits = np.stack([(scores[g] * n[:, None]).sum(0) + bias for (g, n), out in zip(rows, left_out, strict=True) if out])
            picks = target[left_out]
            loss = {t: -np.log(_softmax(logits / t)[np.arange(len(picks)), picks] + 1e-12).mean() for t in np.geomspace(0.05, 5, 40)}
            temperature = min(loss, key=loss.get)
            threshold = min((0.5 + min(0.5, 1 / len(languages))) / 2, float(np.quantile(_softmax(logits / temperature).max(1), reject_share)))
        return pd.DataFrame(
            {"scores": [(scores / temperature).astype(np.float32).tobytes()], "bias": [(bias / temperature).astype(np.float64).tobytes()], "threshold": [threshold]}
        )

    # One group by design: the sample is bounded for each language.
    found = counts.withColumn("all", F.col("key") % 1).groupBy("all").applyInPandas(learn, "scores binary, bias binary, threshold double").first()
    scores = np.frombuffer(found.scores, np.float32).reshape(1 << bits, len(languages))
    return Model(languages, bits, scores, np.frombuffer(found.bias, np.float64), found.threshold)


def hash_of(key: int) -> int:
    return (int(key) * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> 40


def predict(docs: DataFrame, model: Model, text: str = "text", names: tuple[str, str, str] = ("lang_pred", "score", "accepted")) -> DataFrame:
    """All columns of ``docs``, and three more, named by ``names``: language, score, and whether the score is above the threshold."""
    languages, bits, scores, bias, threshold = model.languages, model.bits, model.table, model.bias, model.threshold
    has = fresh(docs, "_letter")
    rows = docs.withColumn(has, F.coalesce(column(text).rlike(r"\p{L}"), F.lit(False)))
    at = docs.columns.index(text)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", `{names[0]}` string, `{names[1]}` double, `{names[2]}` boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = len(languages)
        words = np.array([*languages, UNKNOWN], object)
        for batch in batches:
            bounds, data = utf8(batch.column(at))
            sums, sizes = np.zeros((batch.num_rows, classes)), np.zeros(batch.num_rows)
            for part, starts, of in pieces(bounds, data):
                for where, gram in subwords(part, starts, bits):
                    # The grams of a row are neighbours; rows without any keep a zero.
                    edge = np.searchsorted(where, starts)
                    n = np.diff(np.append(edge, len(where)))
                    full = np.flatnonzero(n)
                    if len(full):
                        np.add.at(sizes, of[full], n[full])
                        for c in range(classes):
                            np.add.at(sums[:, c], of[full], np.add.reduceat(scores[:, c][gram], edge[full], dtype=np.float64))
            letter = np.array(batch.column(batch.num_columns - 1)) & (classes > 0)
            best, top = np.full(batch.num_rows, classes), np.zeros(batch.num_rows)
            if classes and batch.num_rows:
                p = _softmax(sums / np.maximum(sizes, 1)[:, None] + bias)
                best, top = np.where(letter, p.argmax(1), classes), np.where(letter, p.max(1), 0.0)
            arrays = [batch.column(i) for i in range(batch.num_columns - 1)]
            arrays += [pa.array(words[best], pa.string()), pa.array(top, pa.float64()), pa.array(letter & (top >= threshold), pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names[:-1], *names])

    return rows.mapInArrow(run, schema)


def training_sample(docs: DataFrame, per_language: int = PER_LANGUAGE, most: int = SAMPLE_ROWS) -> DataFrame:
    """Documents with a language outside the held-out fold, ``per_language`` of each and ``most`` of all at the most.

    With more languages than fit in ``most`` rows there is one document of each.
    """
    ids = docs.where("doc_id is not null and lang is not null and text is not null").where(
        F.crc32(F.col("doc_id").cast("string")) % FOLDS != HELD_OUT
    )
    # Hashes below twice the share that is wanted, and some rows more, leave a bounded number of rows of each language to rank, however
    # many it has; the rank then picks the first of them.
    ids = ids.select("doc_id", "lang", F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 40)).alias("draw"))
    counts = kept(ids.groupBy(F.col("lang").alias("of")).agg(F.count("*").alias("n")), "language-counts")
    languages = counts.count()
    per_language = max(1, min(per_language, most // max(1, languages)))
    few = ids.join(F.broadcast(counts) if languages <= SENT_COUNTS else counts, F.col("lang") == F.col("of")).where(F.col("draw").cast("double") * F.col("n") < F.lit((2.0 * per_language + 20) * (1 << 40)))
    order = Window.partitionBy("lang").orderBy("draw", "doc_id")
    ids = few.withColumn("place", F.row_number().over(order)).where(F.col("place") <= per_language)
    ids = kept(ids.select("doc_id", "lang").dropDuplicates(["doc_id"]), "language-ids")
    return docs.select("doc_id", "text").join(ids, "doc_id").select(F.col("doc_id").cast("bigint").alias("key"), "text", "lang")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, learned from the other folds; ``accepted`` is false below the threshold."""
    docs = table(spark, sf_dir, "documents")
    model = fit(training_sample(docs))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_OUT, F.lit(False))
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held.alias("held_out"), "lang_pred", "score", "accepted")


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents whose language is known well enough stay."""
    names = (fresh(docs, "_lang"), fresh(docs, "_score"), fresh(docs, "_accepted"))
    return predict(docs, fit(training_sample(docs)), names=names).where(column(names[2])).select(*[column(c) for c in docs.columns])
