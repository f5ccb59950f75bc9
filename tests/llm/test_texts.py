"""Operators over single texts, against plain versions of the same."""

import hashlib
import re
import sys
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import regex
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parent))
from frames import ODD, crowded, documents_dir, empty_documents, odd_documents

from tidemark.llm import bpe, language, licenses, pii, toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# --- toxicity ----------------------------------------------------------------------------------------


def plain_features(text, bits):
    """The feature set of one text, word by word."""
    table = {**{c: chr(c).lower() for c in range(128) if chr(c).isalnum()}}
    words = re.findall(rb"[0-9A-Za-z\x80-\xff]+", text.encode())
    mask = (1 << 64) - 1
    base, odd = toxicity._BASE, [int(x) for x in toxicity._ODD]

    def word(w):
        w = bytes(ord(table[b]) if b < 128 else b for b in w)
        return sum(b * pow(base, i, 1 << 64) for i, b in enumerate(w)) & mask

    def place(x):
        x &= mask
        return (((x ^ (x >> 29)) * odd[3]) & mask) >> (64 - bits)

    hashed = [word(w) for w in words]
    found = {place(h * odd[0]) for h in hashed}
    for gap in (1, 2):
        for a, b in zip(hashed, hashed[gap:]):
            found.add(place(a * odd[gap] + (b ^ (b >> 31)) * odd[3]))
    return found


def test_features_are_those_of_the_plain_version_and_stay_in_their_row():
    texts = [t or "" for _, t, *_ in ODD if t is None or len(t) < 1000]
    data = [t.encode() for t in texts]
    starts = np.cumsum([0, *map(len, data[:-1])])
    rows, found = toxicity.features(np.frombuffer(b"".join(data), np.uint8), starts, 16)
    for i, text in enumerate(texts):
        # Of texts that begin at one byte only the last has any bytes.
        assert set(found[rows == i]) == plain_features(text, 16)


def test_scores_learn_planted_words_and_reruns_agree(spark):
    rng = np.random.default_rng(3)
    plain = [" ".join(f"w{x}" for x in rng.integers(0, 300, 40)) for _ in range(600)]
    rows = [(i, t + (" vile beast" if i % 4 == 0 else ""), int(i % 4 == 0)) for i, t in enumerate(plain)]
    frame = spark.createDataFrame(rows, "key bigint, text string, label int")
    model = toxicity.fit(frame.where("key < 400"), bits=16)
    assert 0 < len(model.places) < 500  # most of the places seen have no weight
    scored = toxicity.score(frame.where("key >= 400"), model, keep=("key", "label")).collect()
    assert np.mean([r.predicted == r.label for r in scored]) > 0.97
    again = toxicity.fit(frame.where("key < 400").repartition(5), bits=16)
    assert (again.places == model.places).all() and np.allclose(again.weights, model.weights) and again.bias == pytest.approx(model.bias)


def test_toxicity_stands_odd_rows(spark, tmp_path):
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 0), (4, None, None), (None, 1, 1), (8, 0, 0)], "doc_id bigint, quality int, toxic int")
    folder = documents_dir(crowded(odd_documents(spark)), tmp_path / "odd", labels=labels)
    rows = toxicity.op1_toxicity(spark, folder).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert {(r.doc_id, r.held_out) for r in rows if r.doc_id} == {(i, zlib.crc32(str(i).encode()) % 5 == 0) for i, *_ in ODD if i}
    none = toxicity.Model(16, np.zeros(0, np.int64), np.zeros(0), -1.0)
    assert toxicity.score(empty_documents(spark), none).collect() == []


def test_toxicity_on_held_out_labels(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "toxic")
    scored = toxicity.op1_toxicity(spark, "/root/testdata/sf0.01").join(labels, "doc_id")
    right = scored.where("held_out").select(F.avg((F.col("predicted") == F.col("toxic")).cast("int"))).first()[0]
    assert right > 0.85


def test_toxic_rows_are_found_in_a_small_table(spark):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").select("doc_id", "toxic")
    scored = toxicity.op1_toxicity(spark, "/root/testdata/sf0.001").join(labels, "doc_id")
    found, toxic, false = scored.where("not held_out").select(F.sum(F.col("predicted") * F.col("toxic")), F.sum("toxic"), F.sum(F.col("predicted") * (1 - F.col("toxic")))).first()
    assert toxic == 10 and found >= 5 and false == 0


def test_rare_toxic_rows_are_all_drawn_and_found(spark):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 300, 30)) + (" vile beast" if i % 100 == 0 else ""), int(i % 100 == 0)) for i in range(12_000)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, label int").cache()
    sample, odds = toxicity.training_sample(frame.drop("label"), frame.select("doc_id", F.col("label").alias("toxic")), most=1_000)
    seen = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    positive = sum(1 for i, _, label in rows if label and zlib.crc32(str(i).encode()) % 5)
    others = sum(1 for i, _, label in rows if not label and zlib.crc32(str(i).encode()) % 5)
    assert seen == {1: positive, 0: 1_000 - positive} and odds == pytest.approx(-np.log((1_000 - positive) / others))
    scored = toxicity.score(frame, toxicity.fit(sample, bits=16, odds=odds), keep=("label",)).groupBy("label").agg(F.avg("predicted").alias("share"))
    assert {r.label: r.share for r in scored.collect()} == {1: pytest.approx(1, abs=0.1), 0: pytest.approx(0, abs=0.001)}


# --- language ----------------------------------------------------------------------------------------


def test_language_of_held_out_documents(spark, docs):
    rows = language.op5_language_id(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.95 and all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.accepted for r in rows]) > 0.98


def test_the_sample_of_many_languages_is_bounded(spark):
    docs = spark.range(2_000).selectExpr("id as doc_id", "concat('l', id % 50) as lang", "'some text' as text")
    sizes = {r["lang"]: r["count"] for r in language.training_sample(docs, most=200).groupBy("lang").count().collect()}
    assert set(sizes.values()) == {4} and len(sizes) == 50
    assert language.training_sample(docs, most=10).count() == 50


def test_language_of_odd_rows(spark, tmp_path):
    rows = language.op5_language_id(spark, documents_dir(crowded(odd_documents(spark)), tmp_path / "odd")).collect()
    unknown = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert len(rows) == len(ODD) and {2, 3, 8} <= unknown and not {1, 4, 9} & unknown
    assert language.op5_language_id(spark, documents_dir(empty_documents(spark), tmp_path / "none")).collect() == []


def test_subword_sums_do_not_depend_on_pieces_or_neighbours(spark):
    texts = ["der hund und die katze", "", "a", "the cat", "ab " * 4000]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    rng = np.random.default_rng(0)
    model = language.Model(("x", "y"), 10, rng.normal(size=(1024, 2)).astype(np.float32), np.zeros(2), 0.0)
    together = {r.doc_id: r.score for r in language.predict(frame, model).collect()}
    alone = {r.doc_id: r.score for i in range(len(texts)) for r in language.predict(frame.where(F.col("doc_id") == i), model).collect()}
    assert together == pytest.approx(alone)


def test_stage_keeps_identified_documents_and_their_columns(spark, docs):
    kept = language.keep_identified(spark, docs, SF)
    assert kept.columns == docs.columns and kept.count() >= 0.98 * docs.count()


# --- licenses ----------------------------------------------------------------------------------------


def plain_words(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text)


def plain_scan(text):
    words = plain_words(text)
    places = []
    for phrase, label in licenses.BASE.items():
        parts = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    joined = " ".join(words).encode()
    fuzzy = {x.label for x in licenses.notices() if x.pattern.search(joined)}
    return len(words), places, {label for _, label in places} | fuzzy


def test_every_document_has_the_findings_of_a_full_search(spark, docs):
    texts = dict(docs.select("doc_id", "text").collect())
    for row in licenses.op3_license_scan(spark, SF).collect():
        n, places, labels = plain_scan(texts[row.doc_id])
        at = [i for i, _ in places]
        assert (row.n_words, row.n_base, row.first_word, row.last_word) == (n, len(places), min(at, default=None), max(at, default=None))
        assert row.base_labels == ",".join(sorted({label for _, label in places})) and row.labels == ",".join(sorted(labels))
        assert 0 <= row.score <= 1


@pytest.mark.parametrize(
    "text, within",
    [
        ("Licenced under teh Apache License, Version 2.0", True),
        ("Released undr the M.I.T license", True),
        ("GNU Genral Public Licence", True),
        ("GNU Genral Public Lisence", False),  # three errors in 26 bytes, one more than their bound
        ("all rihgts reserved", True),
        ("nothing here", False),
    ],
)
def test_misspelt_notices(text, within):
    _, _, labels = plain_scan(text)
    found = licenses.scan(text.encode())
    assert {s[0] for s in found["spans"]} | {label for label, _ in found["base"]} == labels
    assert bool(labels) == within


def test_overlapping_and_edge_places():
    assert licenses.places(b"cc by cc by", b"cc by") == [0, 6]
    assert licenses.places(b"acc by cc bye", b"cc by") == []


def test_licenses_of_odd_rows(spark):
    rows = licenses.find_licenses(crowded(odd_documents(spark))).collect()
    assert len(rows) == len(ODD) and all(r.labels == "" and r.n_base == 0 and r.score == 0 for r in rows)
    assert licenses.find_licenses(empty_documents(spark)).collect() == []


# --- pseudonyms --------------------------------------------------------------------------------------


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def plain_feistel(left, right, a, b, kind, key=pii.DEFAULT_KEY):
    for i in range(1, pii.ROUNDS + 1):
        other = right if i % 2 else left
        moved = int(hashlib.sha256(f"{key}:{kind}:{i}:{other}".encode()).hexdigest()[:14], 16)
        if i % 2:
            left = (left + moved) % a
        else:
            right = (right + moved) % b
    return left, right


def pseudonyms(spark, *texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    return [r for r in pii.pseudonymize(frame, counts=("n", "kinds")).orderBy("doc_id").collect()]


def test_pseudonyms_keep_format_and_link_equal_values(spark):
    first, second, third = pseudonyms(
        spark,
        "card 4845168114407329, again 4845168114407329; phone +1 (459) 555-9246 ip 97.51.17.173",
        "4845-1681-1440-7329 and +1 459 555 9246 on 2024-02-29 or 29.02.2024, ssn 219-09-9999, x.y@mail.example.com",
        "not: 4845168114407328 1.2.3.400 2023-02-29 000-12-1234 12345",
    )
    card = re.findall(r"[0-9]{16}", first.text)
    assert len(card) == 2 and card[0] == card[1] != "4845168114407329" and luhn(card[0])
    assert card[0] in second.text.replace("-", "")
    left, right = plain_feistel(4845168, 11440732, 10**7, 10**8, "card15")
    assert card[0][:-1] == f"{left:07d}{right:08d}"
    phones = [re.sub("[^0-9]", "", m) for m in re.findall(r"\+1[ (0-9)-]*[0-9]", first.text + " " + second.text)]
    assert len(phones) == 2 and phones[0] == phones[1] != "14595559246"
    days = re.search(r"on ([0-9]{4})-([0-9]{2})-([0-9]{2}) or ([0-9]{2})\.([0-9]{2})\.([0-9]{4})", second.text).groups()
    assert days[:3] == (days[5], days[4], days[3]) and "2024-02-29" not in second.text
    ip = plain_feistel(97 * 256 + 51, 17 * 256 + 173, 65536, 65536, "ip")
    assert first.text.endswith(".".join(map(str, (*divmod(ip[0], 256), *divmod(ip[1], 256)))))
    assert (first.n, first.kinds) == (4, "card,ip,phone") and second.kinds == "card,date,email,phone,ssn"
    assert third.n == 0 and third.text.endswith("12345") and "4845168114407328 1.2.3.400 2023-02-29" in third.text


def test_pseudonyms_are_a_permutation_that_the_key_undoes(spark):
    frame = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("value"), "id")
    moved = frame.withColumn("moved", F.expr(pii.permuted_digits("value", "'phone'", pii.DEFAULT_KEY)))
    assert moved.select("moved").distinct().count() == 1000
    back = pii.restore_digits(moved, "moved", "phone")
    assert back.where("moved <> value").count() == 0


def test_no_number_that_passes_is_left_and_the_rest_is_untouched(spark, docs):
    texts = dict(docs.select("doc_id", "text").collect())
    pattern = regex.compile(pii.ANY)
    for row in pii.op9_pii_pseudonyms(spark, SF).collect():
        old, new = texts[row.doc_id], row.text
        gaps = regex.split(pii.ANY, old)
        at = 0
        for gap in gaps:
            at = new.index(gap, at) + len(gap)
        valid = {m for m in pattern.findall(old) if "@" in m or (len(m) == 16 and m.isdigit() and luhn(m)) or m.startswith("+")}
        assert not any(v in new for v in valid) and (row.n_replaced > 0) == (old != new)


def test_pseudonyms_in_odd_rows(spark):
    odd = crowded(odd_documents(spark))
    out = pii.pseudonymize(odd)
    assert out.columns == odd.columns
    assert sorted(map(str, out.collect())) == sorted(map(str, odd.collect()))
    assert pii.pseudonymize(empty_documents(spark)).collect() == []


# --- byte pairs --------------------------------------------------------------------------------------

PATH = public_tokenizers.path(bpe.VOCABULARY)
STRANGE = [
    "",
    "<|endoftext|> Hello<|startoftext|>ＩSTANBUL İstanbul ΣΑΣ naïve don't 've",
    "１２ 漢字テスト \U0001f600 á ﬁ <|EndOfText|> \x00\x01\u0085\xa0x　y",
    "a" * 3000 + " " + "ß" * 300,
    "ábçd ³²½ ªº ŉ ĸ it's I'LL we'Re",
]


def plain_encoding(texts):
    whole = Tokenizer.from_file(PATH)
    whole.no_padding()
    whole.no_truncation()
    ids = [whole.encode(t, add_special_tokens=False).ids for t in texts]
    return ids, [whole.decode(x, skip_special_tokens=False) for x in ids]


def test_ids_and_texts_are_those_of_the_library(spark, docs):
    texts = [r.text for r in docs.select("text").collect()] + STRANGE
    own = bpe.Codec(PATH, remembered=50)
    ids, decoded = plain_encoding(texts)
    assert [own.encode(t) for t in texts] == ids
    assert [own.decode(x) for x in ids] == decoded


def test_words_are_cut_only_where_no_token_runs():
    own = bpe.Codec(PATH)
    parts = own.fragments("qzxjvqword")
    assert "".join(parts) == "qzxjvqword"
    for a, b in zip(parts, parts[1:]):
        assert not any(a[-1] + b[0] in own._bare(token) for token in own.ids)


def test_encoding_odd_rows(spark):
    rows = bpe.digests(crowded(odd_documents(spark)), PATH).collect()
    ids, decoded = plain_encoding([t or "" for _, t, *_ in ODD])
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    expected = [(i, len(x), sha(" ".join(map(str, x))), sha(d)) for (i, *_), x, d in zip(ODD, ids, decoded)]
    assert sorted(map(str, (tuple(r) for r in rows))) == sorted(map(str, expected))
    assert bpe.digests(empty_documents(spark), PATH).collect() == []
    back = bpe.decode(bpe.encode(odd_documents(spark), PATH), PATH)
    assert sorted(r.text for r in back.collect()) == sorted(decoded)
