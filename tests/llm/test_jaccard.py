"""The Jaccard join against all pairs of plain sets."""

import re
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
from frames import ODD, crowded, empty_documents, odd_documents
from test_tables import SF, roots

from tidemark.llm import jaccard
from tidemark.llm.common import small_batches
from tidemark.llm.queries import QUERIES


def plain_set(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", text)
    return {" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))} if words else set()


def plain_components(rows):
    """(id, set size, smallest id) of all rows, by comparing all pairs."""
    sets = [plain_set(t) for _, t in rows]
    pairs = [(i, i) for i in range(len(rows))]
    for i, a in enumerate(sets):
        for j in range(i + 1, len(sets)):
            b = sets[j]
            if a and b and 100 * min(len(a), len(b)) >= 85 * max(len(a), len(b)):
                common = len(a & b)
                if 100 * common >= 85 * (len(a) + len(b) - common):
                    pairs.append((i, j))
    root = roots(pairs)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root[i]] = min(doc_id, least.get(root[i], doc_id))
    return sorted(((rows[i][0], len(sets[i]), least.get(root[i]) if sets[i] else rows[i][0]) for i in range(len(rows))), key=str)


def found_components(frame, **options):
    return sorted((tuple(r) for r in jaccard.similar_documents(frame, **options).collect()), key=str)


def near_copies(groups=6, of=60, seed=0):
    """Groups of texts around one another, with from none to many words replaced, and texts of their own."""
    rng = np.random.default_rng(seed)
    rows, word = [], lambda: f"w{rng.integers(0, 1 << 30)}"
    for g in range(groups):
        base = [word() for _ in range(int(rng.integers(20, 200)))]
        for _ in range(of):
            text = list(base)
            for _ in range(int(rng.integers(0, max(2, len(base) // 25)))):
                text[int(rng.integers(0, len(text)))] = word()
            rows.append(" ".join(text))
    passage = " ".join(word() for _ in range(60))
    rows += [" ".join([word() for _ in range(int(rng.integers(1, 120)))] + [passage]) for _ in range(80)]
    rng.shuffle(rows)
    return [(i, t) for i, t in enumerate(rows)]


@pytest.fixture(scope="module")
def crowd():
    rows = near_copies()
    return rows, plain_components(rows)


LEVELS = {
    "one level": {},
    "three levels": {"pivots": 3, "growth": 12},
    "many levels": {"pivots": 4, "growth": 10, "hot": 2},
}


@pytest.mark.parametrize("options", LEVELS.values(), ids=list(LEVELS))
def test_join_against_all_pairs(spark, crowd, options):
    rows, expected = crowd
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert found_components(frame, **options) == expected


def test_join_of_the_given_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op13_ngram_jaccard_join"](spark, SF).collect())) == sorted(plain_components(rows))


def test_guests_link_what_no_star_does(spark):
    """A chain: each text is near the next one only, so regions are tied by boundary texts alone."""
    words = [f"v{i}" for i in range(400)]
    rows = [(i, " ".join(words[3 * i : 3 * i + 60])) for i in range(60)]
    expected = plain_components(rows)
    assert {c for _, _, c in expected} == {0}
    for pivots in (3,):
        assert found_components(spark.createDataFrame(rows, "doc_id bigint, text string"), pivots=pivots, growth=6) == expected


def test_similarity_of_exactly_the_bound_links(spark):
    """17 of 20 shingles in common: 100 * 17 = 85 * 20."""
    first = [f"a{i}" for i in range(20)]
    rows = [(1, " ".join(first)), (2, " ".join([*first, "x", "y", "z"])), (3, " ".join([*first, "x", "y", "z", "u"]))]
    expected = plain_components(rows)
    assert [c for *_, c in expected] == [1, 1, 1] and 100 * 17 < 85 * 21
    assert found_components(spark.createDataFrame(rows, "doc_id bigint, text string")) == expected
    assert found_components(spark.createDataFrame(rows[::2], "doc_id bigint, text string")) == plain_components(rows[::2])


def test_odd_rows(spark):
    expected = plain_components([(i, t) for i, t, *_ in ODD])
    assert found_components(crowded(odd_documents(spark)).withColumns({c: F.lit(1) for c in ("id", "n", "shingles", "root", "a", "b")})) == expected
    assert jaccard.similar_documents(empty_documents(spark)).collect() == []
    blank = spark.createDataFrame([(1, None), (2, ""), (3, " \n")], "doc_id bigint, text string")
    assert found_components(blank) == [(1, 0, 1), (2, 0, 2), (3, 0, 3)]


def test_long_texts_are_cut_between_words_only(monkeypatch):
    monkeypatch.setattr(jaccard, "PIECE", 16)
    texts = ["", "one two three four five six seven eight nine ten", "a" * 50 + " b c d e", "x y", "\t tail of\x0bwords that go on and on and on ", "ünï çö dé fg hi", "Same same SAME same same"]
    data = [t.encode() for t in texts]
    bounds = np.cumsum([0, *map(len, data)])
    found = jaccard.shingle_sets(bounds, np.frombuffer(b"".join(data), np.uint8))
    assert [len(s) for s in found] == [len(plain_set(t)) for t in texts]
    monkeypatch.setattr(jaccard, "PIECE", 1 << 20)
    whole = jaccard.shingle_sets(bounds, np.frombuffer(b"".join(data), np.uint8))
    assert all((a == b).all() for a, b in zip(found, whole, strict=True))


def test_a_dense_group_makes_stars_not_pairs(spark):
    """2,000 near copies: the links kept are few for each text, though nearly all pairs are similar."""
    rng = np.random.default_rng(1)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(2_000):
        text = list(base)
        text[int(rng.integers(0, 120))] = f"own{i}"
        rows.append((i, " ".join(text)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    sets = frame.select("doc_id", "text", F.col("doc_id").alias("id")).mapInArrow(jaccard._sets_of(4), "doc_id bigint, id bigint, n int, shingles binary")
    assert jaccard.links(sets, pivots=64).count() <= 64 * 2_000
    assert {r.component_id for r in jaccard.similar_documents(frame, pivots=8).collect()} == {0}


def test_members_and_guests_that_cannot_be_near_are_not_compared(spark):
    members = spark.createDataFrame([(1, 9, 0.02), (2, 9, 0.14), (3, 8, 0.01)], "id bigint, pivot bigint, far double")
    guests = spark.createDataFrame([(4, 9, 0.2), (5, 9, 0.295), (6, 8, 0.25), (7, 7, 0.16)], "id bigint, pivot bigint, far double")
    members, guests = jaccard._facing(members, guests, 0.15)
    assert sorted(map(tuple, members.collect())) == [(2, 9, 0.14)]  # the nearest guest is at 0.2, so members below 0.05 are out
    assert sorted(r.id for r in guests.collect()) == [4]  # 0.295 is more than 0.15 behind the farthest member, pivots 8 and 7 have none left


def test_shingles_of_one_tied_group_make_no_pairs(spark):
    firsts = spark.createDataFrame([(70, 1, 9), (70, 2, 9), (71, 2, 9), (71, 3, 9), (72, 4, 9)], "shingle bigint, id bigint, n int")
    edges = spark.createDataFrame([(1, 2)], "a bigint, b bigint")
    assert sorted((r.shingle, r.id) for r in jaccard._between(firsts, edges).collect()) == [(71, 2), (71, 3)]
    assert {r.shingle for r in jaccard._between(firsts, None).collect()} == {70, 71}  # 72 has one owner, so no pair


def test_hot_shingles_are_told_from_one_tied_group_as_others_are(spark):
    rows = [(s, s % 3 == 0, i, 9) for s in range(40) for i in range(s % 4 + 1)]
    firsts = spark.createDataFrame(rows, "shingle bigint, hot boolean, id bigint, n int")
    for edges in (None, spark.createDataFrame([(0, 1), (2, 3)], "a bigint, b bigint")):
        plain, marked = (sorted(map(tuple, jaccard._between(df, edges).select("shingle", "id", "n", "root").collect())) for df in (firsts.drop("hot"), firsts))
        assert marked == plain and plain


def test_first_shingles_know_the_hot_ones(spark):
    sets = spark.createDataFrame([(1, 8, np.arange(8, dtype="<u8").tobytes())], "id bigint, n int, shingles binary")
    found = jaccard.first_shingles(sets, np.array([0, 2, 3, 4, 5, 6, 7], np.uint64), 50).collect()
    assert [(r.shingle, r.hot) for r in found] == [(1, False), (7, True), (6, True), (5, True), (4, True)]  # the hottest, 0, comes last


def packed_sets(spark, sets):
    rows = [(i, len(s), np.sort(np.array(s, "<u8")).tobytes()) for i, s in enumerate(sets)]
    return spark.createDataFrame(rows, "id bigint, n int, shingles binary")


def test_near_copies_that_are_not_near_enough_do_not_meet(spark):
    """200 sets of 60: each has 8 shingles to itself and nearly all of a common base, so none are similar by 85 %."""
    sets = packed_sets(spark, [[*range(1_000 * i + 100, 1_000 * i + 108), *(x for x in range(1, 55) if x not in (i % 54 + 1, i // 54 + 1))][:60] for i in range(200)])
    firsts = jaccard.first_shingles(sets, np.arange(54, 0, -1).astype(np.uint64), 85)
    assert firsts.where("hot").count() >= 400  # the base's shingles come last, but some are among the first
    assert jaccard.meetings(firsts, firsts, 85, same=True).count() == 0


def test_similar_sets_meet_often_enough(spark):
    """Pairs of all sizes at the bound or a little beside it, their own shingles in front, behind or between."""
    rng, sets, expected = np.random.default_rng(3), [], set()
    for _ in range(150):
        n = int(rng.integers(1, 300))
        own = [int(rng.integers(0, n // 8 + 1)) for _ in "ab"]
        pool = rng.choice(1 << 20, n + sum(own), replace=False) + (len(sets) << 20)
        pair = [np.concatenate([pool[: n], pool[n : n + own[0]]]), np.concatenate([pool[: n], pool[n + own[0] :]])]
        if 100 * n >= 85 * (n + sum(own)):
            expected.add((len(sets), len(sets) + 1))
        sets += pair
    sets = packed_sets(spark, sets)
    firsts = jaccard.first_shingles(sets, np.zeros(0, np.uint64), 85)
    found = {tuple(r) for r in jaccard.met(firsts, firsts, 85, same=True).collect()}
    assert 30 < len(expected) < 140 and expected <= found


def test_groups_that_no_pivot_reached_are_tied_by_their_least_member(spark):
    """300 sets of 60 that share 58: all pairs are similar, but no more are made than there are first shingles."""
    sets = packed_sets(spark, [[*range(1, 59), 1_000 + 2 * i, 1_001 + 2 * i] for i in range(300)])
    firsts = jaccard.first_shingles(sets, np.arange(58, 0, -1).astype(np.uint64), 85)
    left, edges = jaccard._starred(firsts, sets, None, 85)
    assert left.count() == 0 and edges.count() == 299


def test_batches_are_small_only_while_asked_for(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    with small_batches(spark, 3):
        sizes = spark.range(10, numPartitions=1).mapInArrow(lambda batches: (pa.record_batch({"n": [b.num_rows]}) for b in batches), "n bigint").collect()
    assert [r.n for r in sizes] == [3, 3, 3, 1] and spark.conf.get(name) == before


def test_guests_are_settled_as_pivots_without_pairs_of_shingles(spark, monkeypatch):
    """Copies around a text that is no pivot: each is a guest of each pivot, and none has to be met by shingles."""
    rng = np.random.default_rng(2)
    base, rows = [f"b{i}" for i in range(200)], []
    for i in range(200):
        text = list(base)
        for at in rng.choice(40, 3, replace=False):
            text[5 * int(at)] = f"own{i}_{at}"
        rows.append((i, " ".join(text)))
    rows.append((200, " ".join(base)))
    taken = []
    monkeypatch.setattr(jaccard, "met", lambda left, *args, met=jaccard.met, **options: taken.append(left.columns) or met(left, *args, **options))
    assert found_components(spark.createDataFrame(rows, "doc_id bigint, text string"), pivots=120) == plain_components(rows)
    assert not [c for c in taken if "pivot" in c]
