"""Near-duplicates by SimHash fingerprints, found through a perfect Golay code.

A fingerprint has 64 bits: bit i is 1 if over half of the hashes of a text's word shingles have it. Two
fingerprints link at two or fewer differing bits.

Search: the 64 bits are cut into three segments of 22, 21 and 21 bits. Two errors leave at least one segment
exact, and at most two of them fall into the segment after it (in a circle). In the 23-bit Golay code every
word is within three bits of just one codeword. A segment's keys are the indices of the codewords to which it
and all its one-bit neighbours decode, one or a few. Segments at two or fewer bits have a neighbour in common,
hence a key. So linked fingerprints share (exact segment, key of the next segment) for one of the three.

Buckets of up to ``bucket`` fingerprints are joined with themselves and verified. Fingerprints in larger
buckets are linked through the 65 words within one bit of each: two are within two bits just if they share
one. At most 65 fingerprints share such a word, so it ties them in a star, not in pairs.

Everything after the fingerprints works on distinct ones; copies of a text cost nothing more.

Defined cases: a null or wordless text has fingerprint zero, which links like any other; repeated rows share a
component; ``component_id`` is the smallest id, null only where a component has no ids; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import column
from tidemark.llm.common import kept, one_of_each, row_keys, table, texts
from tidemark.llm.components import components

SHINGLE = 3
SEED = 42
BUCKET = 32
SEGMENTS = ((0, 22), (22, 21), (43, 21))
_GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
_UPPER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """The fingerprint of a text's UTF-8 bytes."""
    words = text.translate(_UPPER).split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        return digest(joined, SEED)
    starts = np.zeros(len(words) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=starts[1:])
    total, n = np.zeros(64, np.int64), len(words) - width + 1
    for low in range(0, n, 1 << 16):
        high = min(low + (1 << 16), n)
        begin, end = starts[low:high].tolist(), (starts[low + width : high + width] - 1).tolist()
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(begin, end, strict=True)], np.uint64)
        for part in range(0, len(hashes), 255):  # sums of 255 bits fit a byte
            bits = np.unpackbits(hashes[part : part + 255].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            total += np.add.reduce(bits, axis=0, dtype=np.uint8)
    return int(np.packbits(total * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = SHINGLE) -> DataFrame:
    """(``doc_id``, ``fp``, ``key1``, ``key2``) for every row; the keys are hashes of the whole row."""
    first, second = row_keys(docs)
    rows = docs.select(column(doc_id).alias("doc_id"), first.alias("key1"), second.alias("key2"), column(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t, width) for t in texts(batch.column("text"))), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found.view(np.int64)), batch.column("key1"), batch.column("key2")],
                ["doc_id", "fp", "key1", "key2"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, fp bigint, key1 bigint, key2 bigint")


def _remainders(words: np.ndarray) -> np.ndarray:
    """Syndromes: remainders by the generator, of 23-bit words."""
    words = words.copy()
    for bit in range(22, 10, -1):
        words ^= ((words >> bit) & 1) * (_GENERATOR << (bit - 11))
    return words


def golay_table() -> np.ndarray:
    """The error of up to three bits for each of the 2,048 syndromes."""
    single = 1 << np.arange(23)
    pairs = np.unique((single[:, None] ^ single).ravel())
    errors = np.unique(np.concatenate([pairs, (pairs[:, None] ^ single).ravel()]))
    errors = errors[np.bitwise_count(errors) <= 3]
    found = np.zeros(2048, np.int64)
    found[_remainders(errors)] = errors
    return found


def golay_keys(segment: np.ndarray, width: int, errors: np.ndarray) -> np.ndarray:
    """Codeword indices of each word and its one-bit neighbours; repeats are -1."""
    near = segment[:, None] ^ np.concatenate([[0], 1 << np.arange(width)])
    index = (near ^ errors[_remainders(near)]) >> 11
    index.sort(axis=1)
    index[:, 1:][index[:, 1:] == index[:, :-1]] = -1
    return index


def _bucket_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    errors = golay_table()
    for batch in batches:
        whole = np.array(batch.column(0)).astype(np.int64).view(np.uint64)
        parts = [((whole >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int64) for low, width in SEGMENTS]
        for i in range(3):
            j = (i + 1) % 3
            index = golay_keys(parts[j], SEGMENTS[j][1], errors)
            row, place = np.nonzero(index >= 0)
            key = (np.int64(i) << 34) | (parts[i][row] << 12) | index[row, place]
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(whole.view(np.int64)[row])], ["key", "fp"])


def links(distinct: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Edges (``a``, ``b``) between distinct fingerprints (``fp``) at two or fewer bits: all from small buckets, stars else."""
    keyed = kept(distinct.select("fp").mapInArrow(_bucket_keys, "key bigint, fp bigint"), "golay-keys")
    sizes = kept(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "golay-sizes")
    shared = kept(keyed.join(sizes, "key"), "golay-shared")
    small = shared.where(F.col("n") <= bucket).select("key", "fp")
    pairs = (
        small.select("key", F.col("fp").alias("a"))
        .join(small.select("key", F.col("fp").alias("b")), "key")
        .where("a < b and bit_count(a ^ b) <= 2")
        .select("a", "b")
    )
    large = shared.where(F.col("n") > bucket).select("fp").distinct()
    around = large.select("fp", F.explode(F.expr("concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i)))")).alias("near"))
    # At most 65 fingerprints are within one bit of a word.
    tied = around.groupBy("near").agg(F.array_sort(F.collect_list("fp")).alias("all")).where("size(all) > 1")
    stars = tied.select(F.col("all")[0].alias("a"), F.explode(F.expr("slice(all, 2, size(all))")).alias("b"))
    return pairs.unionByName(stars).distinct()


def group(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(``fp``, ``component_id``, ``root``) for every distinct fingerprint; ``root`` is one fingerprint of the component."""
    distinct = kept(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-prints")
    roots = kept(components(links(distinct, bucket)), "print-roots")
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return kept(rooted.join(least, "root").select("fp", "component_id", "root"), "print-groups")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", bucket: int = BUCKET) -> DataFrame:
    """(``doc_id``, ``fingerprint``, ``component_id``) for every row of ``docs``."""
    prints = kept(fingerprints(docs, text, doc_id), "prints")
    return prints.join(group(prints, bucket), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and component."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component the row with the smallest id stays, ties going by the hashes of the rows."""
    prints = kept(fingerprints(docs), "prints")
    grouped = prints.join(group(prints), "fp")
    # Rows without an id come last; the struct of keys decides among repeated ids.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key1", "key2")).alias("first")
    chosen = kept(grouped.groupBy("root").agg(first).select("first.key1", "first.key2"), "chosen")
    rows, key1, key2 = one_of_each(docs)
    chosen = chosen.select(F.col("key1").alias(key1), F.col("key2").alias(key2))
    return rows.join(chosen, [key1, key2], "left_semi").select(*[column(c) for c in docs.columns])
