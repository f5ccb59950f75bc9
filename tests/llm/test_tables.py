"""Operators over whole tables, against brute force on small ones."""

import re
import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
import xxhash
from compare import differences, duckdb_tables
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
from frames import ODD, crowded, documents_dir, empty_documents, odd_documents

import __spark_entry__ as driver
import corpus_pipeline
from tidemark.llm import common, components, lines, mixing, neighbours, simhash, topk
from tidemark.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_queries_are_registered(spark):
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())
    assert [n for n in range(1, 11) if not any(q.startswith(f"op{n}_") for q in QUERIES)] == [] and "pipeline" in QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), duckdb_tables(SF), ORACLES[name]) is None


# --- pieces and components ---------------------------------------------------------------------------


def test_pieces_hold_every_byte_once():
    texts = [b"", b"ab cd", b"x" * 50, b"one two three four five six seven", b"", b"z"]
    bounds, data = np.cumsum([0, *map(len, texts)]), np.frombuffer(b"".join(texts), np.uint8)
    found = defaultdict(bytes)
    for part, starts, rows in common.pieces(bounds, data, 10):
        for i, row in enumerate(rows):
            found[row] += part[starts[i] : starts[i + 1] if i + 1 < len(starts) else None].tobytes()
    assert [found[i] for i in range(len(texts))] == texts


def roots(pairs):
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {x: top(x) for x in list(parent)}


def test_components_of_chains_stars_and_random_edges(spark):
    rng = np.random.default_rng(1)
    pairs = [(i, i + 1) for i in range(100, 140)] + [(7, x) for x in range(200, 260)] + [tuple(map(int, e)) for e in rng.integers(1000, 1400, (300, 2))]
    pairs = [p for p in pairs if p[0] != p[1]]
    found = components.components(spark.createDataFrame(pairs + [(5, 5)] + pairs[:9], "a bigint, b bigint"))
    assert {r.node: r.root for r in found.collect()} == roots(pairs)
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


# --- near-duplicates ---------------------------------------------------------------------------------


def plain_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints):
    distinct = sorted({p for _, p in prints})
    linked = roots([(a, b) for i, a in enumerate(distinct) for b in distinct[i + 1 :] if (a ^ b).bit_count() <= 2] + [(a, a) for a in distinct])
    ids = defaultdict(list)
    for doc_id, p in prints:
        if doc_id is not None:
            ids[linked[p]].append(doc_id)
    return {p: min(ids[linked[p]], default=None) for p in distinct}


def test_near_duplicates_against_all_pairs(spark, docs):
    rows = docs.select("doc_id", "text").collect()
    prints = [(r.doc_id, plain_fingerprint(r.text)) for r in rows]
    groups = plain_groups(prints)
    expected = sorted((i, f"{p:016x}", groups[p]) for i, p in prints)
    assert sorted(tuple(r) for r in simhash.op4_simhash_near_dedup(spark, SF).collect()) == expected


@pytest.mark.parametrize("bucket", [1, 8, 32])
def test_links_of_crowded_fingerprints(spark, bucket):
    rng = np.random.default_rng(bucket)
    prints = set()
    for center in rng.integers(0, 1 << 62, 6):
        for _ in range(60):
            p = int(center)
            for bit in rng.integers(0, 64, int(rng.integers(0, 6))):
                p ^= 1 << int(bit)
            prints.add(p)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = simhash.group(spark.createDataFrame([(p, p) for p in signed], "doc_id bigint, fp bigint"), bucket).collect()
    unsigned = {p % (1 << 64) for p in prints}
    linked = roots([(a, b) for a in unsigned for b in unsigned if (a ^ b).bit_count() <= 2])
    ours = {r.fp % (1 << 64): r.root for r in found}
    assert len(ours) == len(unsigned)
    by_ours, by_plain = defaultdict(set), defaultdict(set)
    for p in unsigned:
        by_ours[ours[p]].add(p)
        by_plain[linked[p]].add(p)
    assert sorted(map(sorted, by_ours.values())) == sorted(map(sorted, by_plain.values()))


def test_golay_keys_are_shared_within_two_bits():
    errors, rng = simhash.golay_table(), np.random.default_rng(0)
    assert len(np.unique(errors)) == 2048 and np.bitwise_count(errors).max() == 3
    for width in (21, 22, 23):
        x = rng.integers(0, 1 << width, 5000)
        y = x ^ (1 << rng.integers(0, width, 5000)) ^ (1 << rng.integers(0, width, 5000))
        kx, ky = simhash.golay_keys(x, width, errors), simhash.golay_keys(y, width, errors)
        assert all(set(a[a >= 0]) & set(b[b >= 0]) for a, b in zip(kx, ky))


def test_near_duplicates_of_odd_rows(spark):
    rows = simhash.near_duplicates(crowded(odd_documents(spark))).collect()
    prints = [(i, plain_fingerprint(t)) for i, t, *_ in ODD]
    groups = plain_groups(prints)
    assert sorted(map(str, rows)) == sorted(map(str, [type(rows[0])(doc_id=i, fingerprint=f"{p:016x}", component_id=groups[p]) for i, p in prints]))
    assert simhash.near_duplicates(empty_documents(spark)).collect() == []


def test_stage_keeps_one_document_of_each_group(spark):
    odd = crowded(odd_documents(spark))
    kept = simhash.keep_one_of_each_group(spark, odd, SF)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 2, 4, 9, None], key=str)
    assert simhash.keep_one_of_each_group(spark, empty_documents(spark), SF).collect() == []


# --- mixing ------------------------------------------------------------------------------------------


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, rising, left = {}, list(names), 1.5 * sum(sizes.values())
    while rising:
        total = sum(weight[s] for s in rising)
        above = [s for s in rising if left * weight[s] / total > 2 * sizes[s]]
        if not above:
            return target | {s: left * weight[s] / total for s in rising}
        for s in above:
            target[s] = 2 * sizes[s]
            left -= target[s]
            rising.remove(s)
    return target


def test_mix_meets_its_targets(spark, docs):
    texts = {r.doc_id: r for r in docs.collect()}
    size = {i: len(re.findall("[^\x20\x09-\x0d]+", r.text or "")) for i, r in texts.items()}
    of_source = Counter()
    for i, r in texts.items():
        of_source[r.source] += size[i]
    target = plain_targets(of_source)
    rows = mixing.op2_source_mix(spark, SF).collect()
    taken, largest = Counter(), Counter()
    for r in rows:
        source = texts[r.doc_id].source
        assert r.size == size[r.doc_id] and r.source_size == of_source[source] and r.target == pytest.approx(target[source])
        assert r.taken % max(1, r.size) == 0 and 0 <= r.taken <= 2 * r.size
        taken[source] += r.taken
        largest[source] = max(largest[source], r.size)
    assert len(rows) == len(texts) and all(abs(taken[s] - target[s]) <= largest[s] for s in of_source)
    again = mixing.op2_source_mix(spark, SF).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_tree_of_buckets_keeps_targets_and_expectation(spark):
    rows = [(i, "w " * (i % 37 + 1), "hot" if i % 3 else f"s{i % 5}", 0) for i in range(900)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string, n bigint")
    runs = [mixing.mix(frame, bucket_rows=20, fan_in=3, seed=s).collect() for s in range(3)]
    for mixed in runs:
        taken, target = Counter(), {}
        for r in mixed:
            taken[r.source] += r.size * (r.base + r.extra)
            target[r.source] = r.target
        assert all(abs(taken[s] - target[s]) <= 37 for s in target)
    assert runs[0] != runs[1]


def test_pairs_keep_words_and_expectation():
    import pandas as pd

    sizes, wanted = [5, 3, 8, 1], [0.3, 0.6, 0.5, 0.9]
    frame = pd.DataFrame({"slot": "a", "size": sizes, "fraction": wanted})
    total, sums = np.dot(sizes, wanted), np.zeros(4)
    for seed in range(4000):
        out = mixing.pair_off(frame, np.random.default_rng(seed))["fraction"].to_numpy()
        assert np.dot(sizes, out) == pytest.approx(total) and ((out > 0) & (out < 1)).sum() <= 1
        sums += out
    assert sums / 4000 == pytest.approx(wanted, abs=0.03)


def test_mix_of_many_sources_has_no_group_with_all_of_them(spark, monkeypatch):
    frame = spark.range(3_000).selectExpr("id as doc_id", "concat('s', id % 1000) as source", "repeat('w ', cast(1 + id % 7 as int)) as text")
    groups = []
    monkeypatch.setattr(mixing, "_climbed", lambda *args, climbed=mixing._climbed: groups.append(climbed(*args)) or groups[-1])
    rows = mixing.mix(frame, bucket_rows=64, fan_in=4).collect()
    assert len(groups) > 1
    for group in groups:
        assert group.groupBy("slot", "bucket").agg(F.countDistinct("share").alias("n")).agg(F.max("n")).first()[0] == 1
        assert group.groupBy("bucket", "share").count().agg(F.max("count")).first()[0] <= 2 * 64
    taken, largest = {}, {}
    for r in rows:
        taken[r.source] = taken.get(r.source, 0) + r.size * (r.base + r.extra)
        largest[r.source] = max(largest.get(r.source, 0), r.size)
    assert all(abs(taken[r.source] - r.target) <= largest[r.source] for r in rows)
    again = {(r.doc_id, r.extra) for r in mixing.mix(frame, bucket_rows=64, fan_in=4).collect()}
    assert again == {(r.doc_id, r.extra) for r in rows}


def test_mix_of_odd_rows(spark, tmp_path):
    odd = crowded(odd_documents(spark))
    rows = mixing.op2_source_mix(spark, documents_dir(odd, tmp_path / "odd")).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, *_ in ODD)
    assert all(r.taken <= 2 * r.size for r in rows) and {r.size for r in rows if r.doc_id in (2, 3, 8)} == {0}
    again = mixing.repeat_to_targets(spark, odd, SF)
    assert again.columns == odd.columns
    assert sum(len((r.text or "").split()) for r in again.collect()) == sum(r.taken for r in rows)
    assert mixing.op2_source_mix(spark, documents_dir(empty_documents(spark), tmp_path / "none")).collect() == []
    assert mixing.repeat_to_targets(spark, empty_documents(spark), SF).collect() == []


# --- lines -------------------------------------------------------------------------------------------


def test_mix_of_a_source_without_words(spark):
    docs = spark.createDataFrame(
        [(1, "a b c", "x"), (2, "", "y"), (3, None, "y"), (4, "d e", None)], "doc_id bigint, text string, source string"
    )
    found = {r.doc_id: (r.target, r.base + r.extra) for r in mixing.mix(docs).collect()}
    assert found[2] == found[3] == (0.0, 0) and found[1][0] + found[4][0] == 7.5
    assert {r.base + r.extra for r in mixing.mix(docs.where("source = 'y'")).collect()} == {0}


def test_windows_are_removed_after_their_first_place(spark):
    passage = "first line\nsecond line\nthird line\nfourth line"
    rows = [(1, f"top\n{passage}\nend"), (2, f"{passage}"), (3, f"own\n\n{passage.replace(chr(10), chr(10) * 2)}\n\nlast"), (4, "a\nb\na\nb\na\nb"), (5, "first line\nsecond line\nother")]
    out = lines.remove_repeated_windows(spark.createDataFrame(rows, "doc_id bigint, text string"), counts=("n", "gone"))
    found = {r.doc_id: (r.text, r.gone) for r in out.collect()}
    assert found[1] == (rows[0][1], 0) and found[5] == (rows[4][1], 0) and found[2] == ("", 4)
    assert found[3] == ("own\n\n\n\n\n\nlast", 4) and found[4] == ("a\nb", 4)


def test_lines_of_odd_rows(spark):
    odd = crowded(odd_documents(spark))
    out = lines.remove_repeated_windows(odd)
    assert out.columns == odd.columns and sorted(map(str, out.collect())) == sorted(map(str, odd.collect()))
    assert lines.remove_repeated_windows(empty_documents(spark)).collect() == []


# --- search ------------------------------------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<float>, label int"


def odd_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=6)], 0) for i in range(0, 400)]
    rows += [(i, [1.0, 0.5, 0.0, 0.0, 0.0, 0.25], 1) for i in range(400, 700)]  # one vector that many rows share
    rows += [(1000, None, 0), (1050, [], 0), (1100, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0), (1150, [float("nan")] * 6, 0), (1200, [float("inf")] * 6, 0)]
    rows += [(None, [1.0] * 6, 0), (0, rows[0][1], 0), (2000, [1.0, 2.0], 0), (2050, [2.0, 1.0], 0), (3000, [0.0] * 6, 0)]
    return spark.createDataFrame(rows, VECTORS)


def valid_vectors(df, zero):
    found = {}
    for r in df.select("vec_id", "embedding").collect():
        v = r.embedding
        if r.vec_id is None or not v or any(x is None or not np.isfinite(x) for x in v) or not (zero or any(v)):
            continue
        found[r.vec_id] = np.array(v, float)
    return found


def plain_top(vectors, every, top, score):
    out = {}
    for q, v in vectors.items():
        if q % every == 0:
            scored = [(-score(v, x), i) for i, x in vectors.items() if i != q and len(x) == len(v)]
            out[q] = [(i, -s) for s, i in sorted(scored)[:top]]
    return out


@pytest.mark.parametrize("sizes", [{}, {"block": 3, "shard": 40, "fan_in": 2}])
def test_exact_search_against_brute_force(spark, sizes):
    frame = odd_vectors(spark).withColumns({"score": F.lit(1), "rank": F.lit(1), "query_id": F.lit(1), "vector": F.lit(1)})
    expected = plain_top(valid_vectors(frame, True), 50, 5, lambda a, b: int(np.dot(np.floor(256 * a), np.floor(256 * b))))
    found = defaultdict(list)
    for r in topk.top_k(frame, "vec_id % 50 = 0", **sizes).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.vec_id, r.score))
        assert r.rank == len(found[r.query_id])
    assert dict(found) == {q: x for q, x in expected.items() if x}


def test_large_products_stay_exact():
    q = np.array([[2.0**40, 3.0]])
    assert topk.best_of_tile(q, np.array([9]), np.array([[2.0**20, 1.0]]), np.array([1]), 5) == [(9, 1, 2**60 + 3)]


@pytest.mark.parametrize("sizes", [{}, {"leaf": 40, "block": 5, "shard": 16}])
def test_neighbours_are_scored_exactly_and_mostly_found(spark, sizes):
    vectors = valid_vectors(odd_vectors(spark), False)
    expected = plain_top(vectors, 20, 20, lambda a, b: float((a * b).sum()))
    found = defaultdict(list)
    for r in neighbours.nearest(odd_vectors(spark), "vec_id % 20 = 0", **sizes).orderBy("query_id", "rank").collect():
        found[r.query_id].append(r.vec_id)
        assert r.score == pytest.approx(float((vectors[r.query_id] * vectors[r.vec_id]).sum()), rel=1e-12) and r.vec_id != r.query_id
        assert r.rank == len(found[r.query_id])
    assert all(len(found[q]) == len(x) for q, x in expected.items())
    assert np.mean([len(set(found[q]) & {i for i, _ in x}) / len(x) for q, x in expected.items() if x]) >= 0.9
    shared = [i for i in range(400, 700) if i % 20 == 0]
    for q in shared:  # ties go to the smallest ids
        ties = [i for i, _ in expected[q] if 400 <= i < 700]
        assert [i for i in found[q] if 400 <= i < 700] == ties


def test_neighbours_of_the_given_table(spark):
    frame = spark.read.parquet(f"{SF}/embeddings.parquet")
    expected = plain_top(valid_vectors(frame, False), 20, 20, lambda a, b: float((a * b).sum()))
    found = defaultdict(set)
    for r in neighbours.op8_nearest_neighbours(spark, SF).collect():
        found[r.query_id].add(r.vec_id)
    assert np.mean([len(found[q] & {i for i, _ in x}) / 20 for q, x in expected.items()]) >= 0.9


def test_searches_of_empty_tables(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert topk.top_k(empty, "vec_id % 50 = 0").collect() == []
    assert neighbours.nearest(empty, "vec_id % 20 = 0").collect() == []


# --- pipeline ----------------------------------------------------------------------------------------


def test_pipeline_stages_take_effect(spark, docs):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "source_mix", "bpe_encode"]
    frame, sizes = docs, []
    for name, stage in corpus_pipeline.STAGES:
        frame = common.kept(stage(spark, frame, SF), "test-stage")
        sizes.append(frame.count())
        assert name == "bpe_encode" or frame.columns == docs.columns
    identified, unlined, distinct, mixed, encoded = sizes
    assert docs.count() >= identified >= 0.98 * docs.count() and unlined == identified > distinct > 0 and mixed == encoded
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, frame.collect()))


def test_pipeline_of_odd_rows(spark, tmp_path):
    folder = documents_dir(crowded(odd_documents(spark)), tmp_path / "odd")
    assert {r.doc_id for r in corpus_pipeline.run(spark, folder).collect()} <= {i for i, *_ in ODD}
    assert corpus_pipeline.run(spark, documents_dir(empty_documents(spark), tmp_path / "none")).collect() == []
