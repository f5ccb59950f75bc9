"""License scans: short notices found with a few errors, and the places of base phrases.

A text is lower-cased (A-Z), cut into words of ASCII letters, digits and bytes above ASCII, and joined by
single spaces. Base phrases are places where their words stand consecutively.

Fuzzy search: a notice that may have k errors (inserted, deleted or replaced bytes) is cut into k + 1 seeds;
k errors leave at least one seed untouched, so only places around an exact seed are candidates. There the
regex library's bounded-error matching verifies the notice and gives its span.

Defined cases: a null or empty text has no words, no labels and score 0; repeated rows are scanned each; very
long texts are searched whole; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from tidemark.functions import column
from tidemark.llm.common import table, texts

# Base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Short notices by label, in words as they are after cutting.
NOTICES = {
    "apache": ("licensed under the apache license version 2 0",),
    "bsd": ("redistribution and use in source and binary forms",),
    "cc-by": ("creative commons attribution",),
    "gpl": ("licensed under the gnu general public license", "gnu general public license"),
    "lgpl": ("gnu lesser general public license",),
    "mit": ("released under the mit license", "permission is hereby granted free of charge to any person"),
    "mpl": ("subject to the terms of the mozilla public license",),
    "reserved": ("all rights reserved",),
}
#: One error for so many bytes of a notice.
BYTES_PER_ERROR = 9

_KEEP = bytearray(b" " * 256)
for _low, _high in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
    _KEEP[_low : _high + 1] = range(_low, _high + 1)
_KEEP[0x41:0x5B] = range(0x61, 0x7B)
_KEEP = bytes(_KEEP)


@dataclass(frozen=True)
class Notice:
    label: str
    words: bytes
    errors: int
    seeds: tuple[tuple[int, bytes], ...]
    pattern: regex.Pattern


@cache
def notices(bytes_per_error: int = BYTES_PER_ERROR) -> tuple[Notice, ...]:
    """All notices with their seeds and error bounds."""
    found = []
    for label, phrases in NOTICES.items():
        for phrase in phrases:
            words = phrase.encode()
            errors = len(words) // bytes_per_error
            cuts = [len(words) * i // (errors + 1) for i in range(errors + 2)]
            seeds = tuple((a, words[a:b]) for a, b in zip(cuts, cuts[1:], strict=False))
            pattern = regex.compile(rb"(?b)(?<![^ ])(?:%s){e<=%d}(?![^ ])" % (regex.escape(words, special_only=True, literal_spaces=True), errors))
            found.append(Notice(label, words, errors, seeds, pattern))
    return tuple(found)


def normal(text: bytes) -> tuple[bytes, int]:
    """Words of a text joined by single spaces, and their number."""
    words = text.translate(_KEEP).split(b" ")
    words = [w for w in words if w]
    return b" ".join(words), len(words)


def places(joined: bytes, phrase: bytes) -> list[int]:
    """Where the words of a phrase stand in normal text."""
    found, at = [], joined.find(phrase)
    while at >= 0:
        end = at + len(phrase)
        if (at == 0 or joined[at - 1] == 32) and (end == len(joined) or joined[end] == 32):
            found.append(at)
        at = joined.find(phrase, at + 1)
    return found


def windows(joined: bytes, notice: Notice) -> list[tuple[int, int]]:
    """Stretches around exact seeds in which the notice may stand, merged where they meet."""
    spans = []
    for offset, seed in notice.seeds:
        at = joined.find(seed)
        while at >= 0:
            low = at - offset - notice.errors
            spans.append((max(0, low - 1), min(len(joined), low + len(notice.words) + 2 * notice.errors + 1)))
            at = joined.find(seed, at + 1)
    spans.sort()
    merged: list[tuple[int, int]] = []
    for low, high in spans:
        if merged and low <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
        else:
            merged.append((low, high))
    return merged


def matches(joined: bytes, notice: Notice) -> list[tuple[int, int, int]]:
    """(start, end, errors) in bytes of every verified place."""
    found = []
    waiting = windows(joined, notice)
    while waiting:
        low, high = waiting.pop()
        for m in notice.pattern.finditer(joined, low, high):
            found.append((m.start(), m.end(), sum(m.fuzzy_counts)))
            # The best match comes first, wherever it stands: a weaker one may stand before it.
            if m.start() - low >= len(notice.words) - notice.errors:
                waiting.append((low, m.start()))
            low = m.end()
    return sorted(found)


def scan(text: bytes) -> dict:
    """Everything found in one text: words, base places, and (label, first word, last word, errors) of fuzzy notices."""
    joined, n = normal(text)
    base = [(label, at) for phrase, label in BASE.items() for at in places(joined, phrase.encode())]
    spans = [(x, *found) for x in notices() for found in matches(joined, x)]
    if base or spans:
        blanks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
        base = [(label, int(np.searchsorted(blanks, at))) for label, at in base]
        spans = [
            (x.label, int(np.searchsorted(blanks, start)), int(np.searchsorted(blanks, end - 1)), errors, 1 - errors / len(x.words))
            for x, start, end, errors in spans
        ]
    return {"n_words": n, "base": base, "spans": spans}


SCHEMA = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, "
    "spans array<struct<label:string,first_word:bigint,last_word:bigint,errors:int>>"
)


def find_licenses(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """A row of findings for every row: base places, labels, score and the spans of verified notices.

    The score is 1 with a base place, else the share of the best notice that stands without error, else 0.
    """
    rows = docs.select(column(doc_id).alias("doc_id"), column(text).cast("string").alias("text"))
    names = ["doc_id", *(part.strip().split(" ")[0] for part in SCHEMA.split(", ")[:-1]), "spans"]
    span = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("errors", pa.int32())])
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(span)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text_of in texts(batch.column("text")):
                found = scan(text_of)
                base, spans = found["base"], found["spans"]
                at = [word for _, word in base]
                of_base = sorted({label for label, _ in base})
                of_all = sorted({*of_base, *(s[0] for s in spans)})
                score = 1.0 if base else max((s[4] for s in spans), default=0.0)
                out.append(
                    (found["n_words"], len(base), min(at, default=None), max(at, default=None), ",".join(of_base), ",".join(of_all), score, [s[:4] for s in spans])
                )
            columns = list(zip(*out, strict=True)) if out else [()] * len(kinds)
            spans = [[dict(zip(("label", "first_word", "last_word", "errors"), s, strict=True)) for s in row] for row in columns[-1]]
            arrays = [pa.array(c, k) for c, k in zip([*columns[:-1], spans], kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names)

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {SCHEMA}")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's license findings."""
    return find_licenses(table(spark, sf_dir, "documents")).drop("spans")
