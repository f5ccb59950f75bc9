"""Byte-pair encoding and decoding with forced boundaries.

A merge can only ever join what is a token of the vocabulary. So a pair of neighbouring bytes that occurs
inside no token is never joined over: the text can be cut there, the fragments encoded each by itself, and
their ids concatenated. White space and the tokenizer's own word pattern give the first cuts (words), the
pairs that no token holds give the cuts within words. Only a word's last fragment carries the word end.

Fragments are encoded by the vocabulary's merges; results are remembered in a bounded table of each worker,
as words repeat. Special tokens in the text are cut out first, as the tokenizers library does.

Defined cases: null and empty texts have no tokens and decode to the empty text; repeated rows are encoded
each; very long texts are encoded like others, word by word; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import pairwise

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from tokenizers import Tokenizer
from tokenizers.models import BPE

from tidemark.functions import column
from tidemark.llm.common import table

VOCABULARY = "word_bpe_49k.json"
REMEMBERED = 300_000

# Texts without these are lower-cased and split here. Below U+0250 no text changes in NFC, and all Unicode
# versions agree on letters and digits; others take the library's own normalizer and splitter.
_UNUSUAL = re.compile("[^\\t-\\r -~\xa1-\xac\xae-\u024f]")
_CAPITAL_I_DOT = "\u0130"  # its lower case ends in a combining mark


def _byte_letters() -> list[str]:
    """The letters that stand for bytes: printable ones for themselves, the others from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in set(own)]
    letters = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [letters[b] for b in range(256)]


_BYTES = _byte_letters()


class Codec:
    """Encodes and decodes by the vocabulary file at ``path``."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model = told["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        whole = Tokenizer.from_file(path)
        self._normalize, self._split = whole.normalizer.normalize_str, whole.pre_tokenizer.pre_tokenize_str
        self._words = regex.compile(told["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        self._special = re.compile("(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")")
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self._last = BPE(vocab=self.ids, merges=merges, end_of_word_suffix=self.end or None, cache_capacity=0)
        self._inner = BPE(vocab=self.ids, merges=merges, cache_capacity=0)
        self.tokens = [""] * (1 + max([*self.ids.values(), *self.special.values()]))
        for token, i in (self.ids | self.special).items():
            self.tokens[i] = token
        self.numbers = [str(i) for i in range(len(self.tokens))]
        self.joined = {pair for t in map(self._bare, self.ids) for pair in pairwise(t)}
        self._known: dict[str, tuple[int, ...]] = {}
        self._remembered = remembered

    def _bare(self, token: str) -> str:
        return token.removesuffix(self.end) if self.end else token

    def fragments(self, word: str) -> list[str]:
        """``word`` cut at every pair that occurs in no token."""
        if self.joined.issuperset(pairwise(word)):
            return [word]
        cuts = [i for i, pair in enumerate(pairwise(word), 1) if pair not in self.joined]
        return [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)], strict=True)]

    def word(self, word: str) -> tuple[int, ...]:
        """Ids of one word, given in the alphabet that stands for bytes."""
        parts = self.fragments(word)
        inner = tuple(t.id for p in parts[:-1] for t in self._inner.tokenize(p))
        return inner + tuple(t.id for t in self._last.tokenize(parts[-1]))

    def _learn(self, chunk: str) -> tuple[int, ...]:
        """Ids of a normalized run without white space; remembered, as runs repeat."""
        words = self._words(chunk)
        if words == [chunk]:
            found = self.word(chunk if chunk.isascii() else "".join(map(_BYTES.__getitem__, chunk.encode())))
        else:
            found = tuple(i for word in words for i in (self._known.get(word) or self._learn(word)))
        if len(self._known) >= self._remembered:
            self._known.clear()
        self._known[chunk] = found
        return found

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        for i, part in enumerate(self._special.split(text) if self.special else [text]):
            if i % 2:
                ids.append(self.special[part])
            elif _UNUSUAL.search(part) or _CAPITAL_I_DOT in part:
                for word, _ in self._split(self._normalize(part)):
                    ids.extend(self.word(word))
            else:
                known = self._known
                for chunk in part.lower().split():
                    ids.extend(known[chunk] if chunk in known else self._learn(chunk))
        return ids

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by spaces: the vocabulary names no decoder."""
        return " ".join(map(self.tokens.__getitem__, ids))


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One codec for each worker and file."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(``doc_id``, ``ids``) for every row."""
    rows = docs.select(column(doc_id).alias("doc_id"), column(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            ids = pa.array([own.encode(t.as_py() or "") for t in batch.column("text")], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(``doc_id``, ``text``) from (``doc_id``, ``ids``); null ids give the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            text = pa.array([own.decode(x.as_py() or []) for x in batch.column("ids")], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), text], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def digests(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Count and digest of each row's ids, and digest of what they decode to, in one pass over the texts."""
    rows = docs.select(column(doc_id).alias("doc_id"), column(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            sizes, of_ids, of_text = [], [], []
            for value in batch.column("text"):
                ids = own.encode(value.as_py() or "")
                sizes.append(len(ids))
                of_ids.append(hashlib.sha256(" ".join(map(own.numbers.__getitem__, ids)).encode()).hexdigest())
                of_text.append(hashlib.sha256(own.decode(ids).encode()).hexdigest())
            arrays = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def op10_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded."""
    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def encode_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: digests of the encoded documents."""
    return digests(docs, public_tokenizers.path(VOCABULARY))
