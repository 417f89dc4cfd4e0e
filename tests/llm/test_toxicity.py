"""Toxicity: folding, matching, held-out accuracy, odd rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from martlet.llm import toxicity
from martlet.llm.catalog import QUERIES
from martlet.llm.common import table

MODEL = toxicity.ToxicityModel(((" idiot ", 4.0), (" moro", 3.0), (" trash ", 4.0)), (-3.0, 1.0, 1.0))


def test_folding():
    assert toxicity.fold("IDIOT") == " idiot "
    for disguised in ("1d10t", "іdіоt", "ｉｄｉｏｔ", "id\u200biot", "I\u0301DIOT", "id!0t"):
        assert " idiot " in toxicity.fold(f"you {disguised} x"), disguised
    assert toxicity.fold("stup!d,fo$$il").split() == ["stupid", "fossil"]
    assert toxicity.fold("stupid$$$ x").split() == ["stupid", "x"]


def test_matching_and_exceptions():
    assert MODEL.weigh("An 1d10t, a moron and mоrоnic")[0] == 4 + 3 + 3
    assert MODEL.weigh("videotidiots antimoron")[0] == 0
    assert MODEL.weigh("put it in the trash can.")[0] == 0
    assert MODEL.weigh("trash! the trash can")[0] == 4
    brute = lambda text: sum(w for t, w in MODEL.terms for i in range(len(text)) if text.startswith(t, i))
    rng = np.random.default_rng(0)
    words = ["idiot", "moron", "trash", "morose", "idiots", "clean", "x"]
    for _ in range(200):
        text = " ".join(rng.choice(words, rng.integers(0, 12)))
        assert MODEL.weigh(text)[0] == brute(toxicity.fold(text))


def test_score_falls_with_length_and_stays_in_range():
    scores = [MODEL.score("idiot " + "clean " * n) for n in (0, 10, 100, 1000)]
    assert scores == sorted(scores, reverse=True) and all(0 <= s <= 1 for s in scores)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op6_toxicity"](spark, sf)
    assert got.count() == table(spark, sf, "documents").count()
    rows = got.join(table(spark, sf, "labels"), "doc_id").where("held_out").collect()
    y, s = np.array([r.toxic for r in rows]), np.array([r.score for r in rows])
    rank = np.argsort(np.argsort(s, kind="stable"), kind="stable")
    auc = (rank[y == 1].sum() - y.sum() * (y.sum() - 1) / 2) / (y.sum() * (len(y) - y.sum()))
    p = np.array([r.predicted for r in rows])
    assert (p == (s >= 0.3)).all()
    assert auc > 0.93 and (p & y).sum() / p.sum() > 0.9 and (p & y).sum() / y.sum() > 0.85


def test_held_out_labels_are_never_learnt(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit_on_labels(docs, labels) == toxicity.fit_on_labels(docs, flipped)


def test_odd_rows(spark):
    rows = [(1, None), (1, ""), (None, "idiot"), (3, "IDIOT " * 30_000), (3, "fine words"), (3, "fine words")]
    df = spark.createDataFrame([(i, t, 1.0, 2) for i, t in rows], "doc_id long, text string, score double, toxic int")
    got = df.select(toxicity.held_out().alias("h"), MODEL.score_column(F.col("text")).alias("s")).collect()
    assert got[0].s == got[1].s and got[2].h is False and got[3].s > 0.9 and got[4].s == got[5].s
    for labels in ([], [(None, 1), (1, None)], [(9, 1)], [(3, 0), (3, 1), (1, 0)]):
        model = toxicity.fit(df, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert {t for t, _ in model.terms} >= {" moron "} and 0 <= model.score("") < model.score("you moron")
    empty = df.where("false")
    assert toxicity.fit(empty, table(spark, "/root/testdata/sf0.001", "labels")).score("moron") > 0.3
    assert empty.select(MODEL.score_column(F.col("text"))).count() == 0


def test_bound_on_labelled_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    assert toxicity.fit(docs, labels, max_labelled=50) != toxicity.fit(docs, labels, max_labelled=400)
