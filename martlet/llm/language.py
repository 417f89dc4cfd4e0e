"""Language identification: averaged hashed subword embeddings, linear softmax.

A text's words, in lower case with their beginnings and ends marked, give subwords:
runs of two to four characters. Each subword hashes to a row of an embedding table;
a text is the mean of the rows of all its subwords, and a linear softmax turns the
mean into languages. Table and softmax are trained together by stochastic gradient descent in numpy, on
the subword counts of whole texts. A part of the labelled texts is kept from
training: it calibrates the probabilities, whose sharpness depends on the number
of subwords, and sets the score below which a prediction counts as rejected.

``fit`` learns from at most ``max_labelled`` texts, of each language the first by a
hash of id, language and text, the languages taken in turn; each text weighs what
its language's share in all labelled texts gives it. That sample's subword counts
(at most ``BUCKETS`` numbers a text) and one row for each of at most
``max_languages`` languages reach the driver. Prediction is one pass without a
shuffle, which hashes the subwords of long texts piece by piece.

Defined cases: a null text or one without a letter is ``und`` with score 0; null
languages are not learnt from, nor are texts without a letter, and a null id
belongs to no held-out part but is not learnt from either; without any language to
learn every text is ``und``; repeated rows are learnt from once and predicted
alike; texts are read whole. Columns other than id, text and language are not read.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from martlet.llm.common import quoted

UNKNOWN = "und"
BUCKET_BITS = 14
BUCKETS = 1 << BUCKET_BITS
DIMENSIONS = 16
GRAMS = (2, 3, 4)
MAX_LABELLED = 6_000
MAX_LANGUAGES = 1_000
EPOCHS = 6
BATCH = 32
RATE = 0.6
#: Of the labelled texts, one in so many calibrates and is not trained on.
CALIBRATION = 5
#: Share of right answers among the predictions that are not rejected.
PRECISION = 0.99
#: Texts of more characters are read in pieces of about this length.
PIECE = 1_000_000

#: Multiplier and finisher of the subwords' hash.
_FACTOR, _FINISH = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """For every code point: 1 for letters, 2 for marks that combine with them, else 0."""
    out = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        category = unicodedata.category(chr(c))[0]
        if category in "LM":
            out[c] = 1 if category == "L" else 2
    return out


def pieces(text: str) -> Iterator[str]:
    """The text in parts of bounded length that end between words."""
    at = 0
    while at < len(text):
        end = at + PIECE
        while end < len(text) and end < at + 2 * PIECE and (text[end].isalpha() or unicodedata.combining(text[end])):
            end += 1
        yield text[at:end]
        at = end


def subword_rows(text: str) -> np.ndarray:
    """Table rows of the subwords of a piece of text, one for each occurrence."""
    folded = unicodedata.normalize("NFC", text).lower()
    codes = np.frombuffer(f" {folded} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = _kinds()[codes]
    if not (kinds == 1).any():
        return np.zeros(0, np.int64)
    inside = kinds > 0
    marked = np.where(inside, codes, 0).astype(np.uint64)  # 0 stands for a word's beginning and end
    found = []
    for n in GRAMS:
        size = len(codes) - n + 1
        if size < 1:
            continue
        # a subword may begin and end with a word's end, between them are letters
        whole = inside[:size] | inside[n - 1 :] if n == 2 else np.ones(size, bool)
        value = np.full(size, n, np.uint64)
        for k in range(n):
            value = value * _FACTOR + marked[k : k + size]
            if 0 < k < n - 1:
                whole = whole & inside[k : k + size]
        value = value[whole]
        value = (value ^ (value >> np.uint64(29))) * _FINISH
        found.append((value >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
    return np.concatenate(found)


def subword_counts(text: str) -> np.ndarray:
    """Occurrences in the whole text of each table row's subwords."""
    out = np.zeros(BUCKETS)
    for piece in pieces(text):
        out += np.bincount(subword_rows(piece), minlength=BUCKETS)
    return out


@dataclass(frozen=True)
class LanguageModel:
    """``table`` (BUCKETS x DIMENSIONS) and ``weights`` (DIMENSIONS x languages)
    as float32 bytes; ``sharpness`` a, b: logits times exp(a + b log(subwords))."""

    languages: tuple[str, ...]
    table: bytes = field(repr=False)
    weights: bytes = field(repr=False)
    sharpness: tuple[float, float] = (0.0, 0.0)
    reject_below: float = 0.0

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages:
            return UNKNOWN, 0.0
        counts = subword_counts(text)
        size = counts.sum()
        if not size:
            return UNKNOWN, 0.0
        table, weights = _arrays(self)
        used = np.flatnonzero(counts)
        mean = (counts[used] / size) @ table[used]
        p = probabilities(mean @ weights, size, self.sharpness)
        best = int(np.argmax(p))
        return self.languages[best], float(min(1.0, max(0.0, p[best])))


@lru_cache(maxsize=2)
def _arrays(model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    table = np.frombuffer(model.table, np.float32).reshape(BUCKETS, DIMENSIONS).astype(np.float64)
    return table, np.frombuffer(model.weights, np.float32).reshape(DIMENSIONS, -1).astype(np.float64)


def probabilities(logits: np.ndarray, counts: np.ndarray, sharpness: tuple[float, float]) -> np.ndarray:
    a, b = sharpness
    x = logits * np.exp(np.minimum(a + b * np.log(np.maximum(counts, 1.0)), 8.0))[..., None]
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    return x / x.sum(axis=-1, keepdims=True)


def train(
    texts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, weights: np.ndarray, classes: int, seed: int = 13
) -> tuple[np.ndarray, np.ndarray]:
    """Embedding table and softmax weights from (rows, counts) of each text, by
    gradient descent on batches in random order with a falling rate."""
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1.0 / DIMENSIONS, 1.0 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    softmax = rng.normal(0, 0.1, (DIMENSIONS, classes)).astype(np.float32)
    means = [(c / c.sum()).astype(np.float32) for _, c in texts]
    x = np.zeros((BATCH, BUCKETS), np.float32)
    steps, done = EPOCHS * -(-len(texts) // BATCH), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(texts))
        for start in range(0, len(order), BATCH):
            chosen = order[start : start + BATCH]
            x[:] = 0
            for i, t in enumerate(chosen):
                x[i, texts[t][0]] = means[t]
            used = np.unique(np.concatenate([texts[t][0] for t in chosen]))
            part = x[: len(chosen), used]
            hidden = part @ table[used]
            p = probabilities(hidden @ softmax, np.ones(len(chosen)), (0.0, 0.0))
            p[np.arange(len(chosen)), labels[chosen]] -= 1
            grad = (p * weights[chosen][:, None]).astype(np.float32)
            rate = np.float32(RATE * (1 - done / steps))
            back = grad @ softmax.T
            softmax -= rate * (hidden.T @ grad)
            # a mean over thousands of subwords moves each row little: the table learns at a higher rate
            table[used] -= np.float32(20) * rate * (part.T @ back)
            done += 1
    return table, softmax


def calibrate(logits: np.ndarray, counts: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[tuple[float, float], float]:
    """Sharpness with the least log loss on texts kept from training, and the
    least score that keeps ``PRECISION`` among the predictions at or above it. As
    in Platt scaling, n right answers are targets of (n + 1) / (n + 2), so that
    texts told apart without error do not ask for certainty."""
    if not len(labels):
        return (0.0, 0.0), 0.0
    best, least = (0.0, 0.0), math.inf
    doubt = 1 / (len(labels) + 2)
    others = max(1, logits.shape[1] - 1)
    for b in np.arange(0.0, 0.81, 0.1):
        for a in np.arange(-4.0, 3.01, 0.25):
            p = probabilities(logits, counts, (float(a), float(b)))
            logs = np.log(np.maximum(p, 1e-12))
            true = logs[np.arange(len(labels)), labels]
            loss = float(-(weights * ((1 - doubt) * true + doubt / others * (logs.sum(axis=1) - true))).sum())
            if loss < least - 1e-9:
                best, least = (float(a), float(b)), loss
    p = probabilities(logits, counts, best)
    score, right = p.max(axis=1), p.argmax(axis=1) == labels
    order = np.argsort(-score, kind="stable")
    share = np.cumsum((weights * right)[order]) / np.cumsum(weights[order])
    good = np.nonzero(share >= PRECISION)[0]
    return best, float(score[order][good[-1]]) if len(good) else 1.0


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows never learnt from: crc32 of the id as text, mod 5, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("long").cast("string")) % 5 == 0, F.lit(False))


def _rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(
        quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).cast("string").alias("text"), quoted(lang_col).cast("string").alias("lang")
    )


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    max_labelled: int = MAX_LABELLED,
    max_languages: int = MAX_LANGUAGES,
) -> LanguageModel:
    """Learn from the rows of ``docs`` that are neither held out nor unlabelled.
    Languages beyond the ``max_languages`` most frequent are not learnt."""
    rows = _rows(docs, id_col, text_col, lang_col)
    usable = rows.where("doc_id is not null and lang is not null and text is not null").where(~held_out())
    usable = usable.where(F.col("text").rlike(r"\p{L}")).withColumn("key", F.xxhash64("doc_id", "lang", "text"))
    counts = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    common = counts.orderBy(F.desc("n"), "lang").limit(max_languages).collect()
    share = {r.lang: r.n for r in common}
    languages = tuple(sorted(share))
    if not languages:
        return LanguageModel((), b"", b"")
    by_hash = W.partitionBy("lang").orderBy("key")
    chosen = (
        usable.where(F.col("lang").isin(*languages))
        .select("lang", "key")
        .distinct()
        .withColumn("turn", F.row_number().over(by_hash))
        .where(F.col("turn") <= max_labelled)
        .orderBy("turn", "key")
        .limit(max_labelled)
        .select("lang", "key")
    )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, key, text in zip(batch.column(0), batch.column(1), batch.column(2)):
                counts = subword_counts(text.as_py())
                used = np.flatnonzero(counts)
                ids, ns = used.astype("<u2").tobytes(), counts[used].astype("<f4").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang.as_py()]), pa.array([key.as_py()]), pa.array([ids], pa.binary()), pa.array([ns], pa.binary())],
                    names=["lang", "key", "ids", "ns"],
                )

    # at most max_labelled rows of a word and a number: a bounded broadcast
    sample = (
        usable.select("lang", "key", "text")
        .join(F.broadcast(chosen), ["lang", "key"])
        .mapInArrow(counted, "lang string, key long, ids binary, ns binary")
        .dropDuplicates(["lang", "key"])
        .collect()
    )
    sample = sorted((r for r in sample if r.ids), key=lambda r: (r.key, r.lang))
    if not sample:
        return LanguageModel((), b"", b"")
    texts = [(np.frombuffer(r.ids, "<u2").astype(np.int64), np.frombuffer(r.ns, "<f4")) for r in sample]
    labels = np.array([languages.index(r.lang) for r in sample])
    total, seen = sum(share.values()), Counter(r.lang for r in sample)
    weights = np.array([min(10.0, share[r.lang] / total * len(sample) / seen[r.lang]) for r in sample])
    kept = np.array([r.key % CALIBRATION == 0 for r in sample])
    if kept.all():
        kept[:] = False
    learn = np.nonzero(~kept)[0]
    table, softmax = train([texts[i] for i in learn], labels[learn], weights[learn], len(languages))
    apart = np.nonzero(kept)[0]
    logits = np.array([(texts[i][1] / texts[i][1].sum()) @ table[texts[i][0]] @ softmax for i in apart]).reshape(len(apart), len(languages))
    sizes = np.array([texts[i][1].sum() for i in apart], dtype=np.float64)
    sharpness, reject_below = calibrate(logits.astype(np.float64), sizes, labels[apart], weights[apart])
    return LanguageModel(languages, table.tobytes(), softmax.tobytes(), sharpness, reject_below)


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score and whether the score is too low to
    trust (``rejected``; always so for ``und``) of every row."""
    rows = docs.select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).cast("string").alias("text"))

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    found = rows.mapInArrow(predicted, "doc_id long, lang_pred string, score double")
    return found.select(
        "doc_id",
        held_out().alias("held_out"),
        "lang_pred",
        "score",
        ((F.col("lang_pred") == UNKNOWN) | (F.col("score") < model.reject_below)).alias("rejected"),
    )
