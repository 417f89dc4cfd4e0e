"""Language identification: accuracy on held-out documents, subwords against a
word-by-word version, defined cases."""

from __future__ import annotations

import unicodedata
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from martlet.llm import language as L
from martlet.llm.catalog import QUERIES
from martlet.llm.common import table

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, key int, turn int, score string, lang_pred string"


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


@pytest.fixture(scope="module")
def model(spark):
    return L.fit(table(spark, SF, "documents"))


def test_held_out_accuracy(spark):
    rows = QUERIES["op13_language"](spark, SF).collect()
    truth = {r.doc_id: r for r in table(spark, SF, "documents").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(truth)
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    test = [r for r in rows if r.held_out and any(c.isalpha() for c in truth[r.doc_id].text or "")]
    right = [r.lang_pred == truth[r.doc_id].lang for r in test]
    assert len(test) > 100 and np.mean(right) >= 0.97
    for lang in {r.lang for r in truth.values()}:
        assert np.mean([ok for r, ok in zip(test, right) if truth[r.doc_id].lang == lang]) >= 0.95
    trusted = [ok for r, ok in zip(test, right) if not r.rejected]
    assert len(trusted) >= 0.9 * len(test) and np.mean(trusted) >= 0.98
    # probabilities mean what they say
    assert abs(np.mean([r.score for r in test]) - np.mean(right)) < 0.03


def test_held_out_labels_source_and_ids_are_not_seen(spark, model):
    docs = table(spark, SF, "documents")
    other = docs.withColumn("lang", F.when(L.held_out(), F.lit("zz")).otherwise(F.col("lang")))
    other = other.withColumn("source", F.lit("x")).repartition(5)
    again = L.fit(other)
    assert again == model and set(model.languages) == {"de", "en", "es", "fr"}


def naive(text):
    """Subwords as strings, with a mark at both ends of a word."""
    folded = unicodedata.normalize("NFC", text).lower()
    words, word = [], ""
    for c in folded + " ":
        if unicodedata.category(c)[0] in "LM":
            word += c
        elif word:
            words.append(f"\0{word}\0")
            word = ""
    return sorted(w[i : i + n] for w in words for n in L.GRAMS for i in range(len(w) - n + 1))


def row_of(subword):
    value, mask = len(subword), 2**64 - 1
    for c in subword:
        value = (value * int(L._FACTOR) + ord(c)) & mask
    value = ((value ^ (value >> 29)) * int(L._FINISH)) & mask
    return value >> (64 - L.BUCKET_BITS)


@pytest.mark.parametrize(
    "text", ["A.", "Étion dans, çouelle", "été ÉTÉ", "x1y a-b  c", "日本語 のテキスト", "ﬁ ß ǅ", "\ud800 lone", "á́"]
)
def test_subwords(text):
    want = np.bincount([row_of(s) for s in naive(text)], minlength=L.BUCKETS)
    assert (L.subword_counts(text) == want).all() and want.sum()


def test_long_texts_are_read_whole():
    text = "word another " * 100_000 + "y" * (2 * L.PIECE + 17) + " und ein ende"
    counts = L.subword_counts(text)
    tail, head = L.subword_counts("und ein ende"), L.subword_counts("word another")
    assert (counts >= tail).all() and (counts >= 100_000 * head).all()
    parts = list(L.pieces(text))
    assert "".join(parts) == text and max(map(len, parts)) <= 2 * L.PIECE


def test_defined_cases(spark, model):
    texts = [None, "", "   ", "123 456 !!", "²³ ½", "😀😀", "́́", "The the and of the thing", "LE LA DES QUE dans " * 60_000]
    rows = [(i, t, "xx", 1, 2, "s", "p") for i, t in enumerate(texts)] + [(7, texts[7], "yy", 1, 2, "s", "p"), (None, texts[7], None, 0, 0, "", "")]
    got = L.identify(spark.createDataFrame(rows, SCHEMA), model).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    for i in range(7):
        assert (by[i].lang_pred, by[i].score, by[i].rejected) == ("und", 0.0, True)
    assert by[7].lang_pred == "en" and by[8].lang_pred == "fr" and by[None].held_out is False
    assert len({(r.lang_pred, r.score) for r in got if r.doc_id in (7, None)}) == 1


def test_learning_from_odd_rows(spark):
    english, german = "the cat and the dog of that house", "der hund und die katze in dem haus"
    ids = [i for i in range(200) if not held(i)]
    rows = [(i, (english if i % 2 else german) + f" {'xyz'[i % 3]}", "en" if i % 2 else "de", 1, 2, "", "") for i in ids]
    odd = [(ids[0], None, "en"), (ids[1], "", "de"), (None, english, "qq"), (ids[2], "12", "num"), (ids[3], english, None)]
    df = spark.createDataFrame(rows + rows[:20] + [(*o, 1, 2, "", "") for o in odd], SCHEMA)
    model = L.fit(df, max_labelled=100)
    assert model.languages == ("de", "en")
    assert model.predict("the dog and the cat")[0] == "en" and model.predict("die katze und der hund")[0] == "de"
    assert L.fit(df, max_labelled=100, max_languages=1).languages in (("de",), ("en",))


def test_nothing_to_learn(spark):
    empty = spark.createDataFrame([], SCHEMA)
    model = L.fit(empty)
    assert model.languages == () and L.identify(empty, model).count() == 0
    unlabelled = spark.createDataFrame([(1, "some words", None, 1, 1, "", "")], SCHEMA)
    assert [r.lang_pred for r in L.identify(unlabelled, L.fit(unlabelled)).collect()] == ["und"]


def test_calibration_is_not_certain():
    logits, labels = np.array([[4.0, 0.0]] * 50 + [[0.0, 4.0]] * 50), np.array([0] * 50 + [1] * 50)
    sharpness, below = L.calibrate(logits, np.full(100, 30.0), labels, np.ones(100))
    p = L.probabilities(logits, np.full(100, 30.0), sharpness).max(axis=1)
    assert 0.95 < p.min() < 0.9999 and below <= p.min()
    labels[:30] = 1  # the low scores of a class are often wrong
    logits[:30] *= 0.2
    sharpness, below = L.calibrate(logits, np.full(100, 30.0), labels, np.ones(100))
    p = L.probabilities(logits, np.full(100, 30.0), sharpness).max(axis=1)
    assert p[:30].max() < below <= p[30:].min()
