"""Toxicity by a weighted lexicon, matched with Aho-Corasick over folded text.

Folding lower-cases, maps homoglyphs and digit substitutions to plain letters
and other separators to spaces. The lexicon holds whole words and word
beginnings with the log-odds of their document frequencies in toxic and clean
labelled texts; hits inside an exception phrase do not count. The sum of the
weights and its share of the text's length go through a logistic curve.

``fit`` learns from at most ``max_labelled`` labelled documents, the first by a
hash of their id, and sends to the driver their counts of the best terms and
two numbers a document, all bounded by that parameter. Scoring is one pass
without a shuffle.

Defined cases: a null or empty text scores what a text without hits scores; a
document labelled twice is toxic if any label says so; null labels are ignored;
labels for missing documents are ignored; without usable labels the seed terms
alone form the lexicon (the query and the pipeline give none, so that every term
of theirs is learnt); repeated rows score alike; texts are folded and matched
whole. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import documents

#: Letters of other scripts that look like Latin ones, and what they look like.
HOMOGLYPHS = dict(
    zip(
        "аеорсухікмтнвѕјԁɡ" "αεορυικντη" "ıɪʟɴʀ",
        "aeopcyxikmthbsjdg" "aeopuikvtn" "iilnr",
    )
)
#: Digits and signs written for letters.
SUBSTITUTES = dict(zip("0134578@$!", "oieastbasi"))
#: Default seeds of ``fit``: terms used, with ``SEED_WEIGHT``, while no labelled text holds them.
SEED_TERMS = (
    "idiot", "moron", "stupid", "loser", "scum", "worthless", "pathetic", "disgusting",
    "trash", "clown", "imbecile", "vermin",
)
SEED_WEIGHT = 4.0
#: Phrases in which a lexicon term is harmless.
EXCEPTIONS = ("trash can", "trash bin", "class clown", "clown fish", "stupid easy", "sore loser")

#: Least score of a document that is rejected.
REJECT_FROM = 0.3

#: The logistic curve before any label is seen: bias, factors of sum and share.
CURVE = (-5.0, 1.5, 2.5)

PREFIXES = range(4, 10)
MAX_TERMS = 2_000
MIN_DOCS = 5
MIN_G2 = 25.0
MIN_WEIGHT = 1.0
LENGTH_SCALE = 100.0

_SIGNS = re.compile(r"(?<=\w)[@$!]+(?=\w)")


@lru_cache(maxsize=1)
def _fold_table() -> dict[int, str]:
    out = {c: " " for c in range(128) if not chr(c).isalnum()}
    out |= {c: chr(c).lower() for c in range(128) if chr(c).isalpha()}
    out |= {ord(d): s for d, s in SUBSTITUTES.items() if d.isdigit()}
    out |= {ord(g): s for g, s in HOMOGLYPHS.items()}
    # full-width forms of the printable ASCII characters
    out |= {0xFF00 + i: out.get(0x20 + i, chr(0x20 + i)) for i in range(1, 95)}
    # combining marks and zero-width characters only disguise
    out |= {c: "" for c in [*range(0x300, 0x370), 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, 0xAD]}
    return out | {c: " " for c in (0xA0, 0x2013, 0x2014, 0x2018, 0x2019, 0x201C, 0x201D, 0x2026)}


def fold(text: str) -> str:
    """Folded text with a space before and after it."""
    if "@" in text or "$" in text or "!" in text:
        text = _SIGNS.sub(lambda m: "".join(SUBSTITUTES[c] for c in m[0]), text)
    return f" {text.lower().translate(_fold_table())} "


def terms_of(folded: str) -> set[str]:
    """Whole words (" word ") and word beginnings (" wor") of a folded text."""
    out = set()
    for word in set(folded.split()):
        out.add(f" {word} ")
        out.update(f" {word[:n]}" for n in PREFIXES if n < len(word))
    return out


@lru_cache(maxsize=4)
def _automaton(terms: tuple[tuple[str, float], ...], exceptions: tuple[str, ...]):  # noqa: ANN202
    import ahocorasick

    machine = ahocorasick.Automaton()
    for term, weight in terms:
        machine.add_word(term, (len(term), weight))
    for phrase in exceptions:
        machine.add_word(f" {phrase} ", (len(phrase) + 2, None))
    if len(machine):
        machine.make_automaton()
    return machine


@dataclass(frozen=True)
class ToxicityModel:
    """terms: (" word " or " wor", weight); curve: bias and the two factors."""

    terms: tuple[tuple[str, float], ...]
    curve: tuple[float, float, float]
    exceptions: tuple[str, ...] = EXCEPTIONS

    def weigh(self, text: str) -> tuple[float, int]:
        """Sum of the weights of hits outside exception phrases; words."""
        folded = fold(text)
        machine = _automaton(self.terms, self.exceptions)
        if not len(machine):
            return 0.0, folded.count(" ")
        hits, free = [], []
        for end, (size, weight) in machine.iter(folded):
            (free if weight is None else hits).append((end - size + 1, end + 1, weight))
        if not hits:
            return 0.0, folded.count(" ")
        if free:
            hits = [h for h in hits if not any(a <= h[0] and h[1] <= b for a, b, _ in free)]
        # a whole word and its beginnings start at one place: the heaviest counts
        best: dict[int, float] = {}
        for at, _, weight in hits:
            best[at] = max(weight, best.get(at, -math.inf))
        return sum(best.values()), folded.count(" ")

    def score(self, text: str) -> float:
        bias, by_sum, by_share = self.curve
        x = bias + float(np.dot(features(*self.weigh(text)), (by_sum, by_share)))
        return 1.0 / (1.0 + math.exp(-min(40.0, max(-40.0, x))))

    def score_column(self, text: Column) -> Column:
        @F.pandas_udf("double")
        def of(texts):  # noqa: ANN001, ANN202
            import pandas as pd

            return pd.Series([self.score(t) for t in texts], dtype="float64")

        return of(F.coalesce(text.cast("string"), F.lit("")))


def features(weight: float, words: int) -> tuple[float, float]:
    return math.log1p(max(0.0, weight)), math.log1p(LENGTH_SCALE * max(0.0, weight) / (words + 20))


def choose_terms(counts: list[tuple[str, int, int]], toxic: int, clean: int) -> list[tuple[str, float]]:
    """Best-first by G2, skipping a term that contains or is contained in a
    chosen one's word beginning."""

    def g2(a: int, b: int) -> float:
        total, both = toxic + clean, a + b
        cells = ((a, toxic, both), (b, clean, both), (toxic - a, toxic, total - both), (clean - b, clean, total - both))
        return 2 * sum(x * math.log(x * total / (m * n)) for x, m, n in cells if x)

    rated = []
    for term, a, b in counts:
        weight = math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5) / (clean + 1))
        if weight >= MIN_WEIGHT and (rate := g2(a, b)) >= MIN_G2:
            rated.append((-rate, -len(term), term, weight))
    chosen: list[tuple[str, float]] = []
    beginnings: set[str] = set()  # of chosen terms, each with all its own beginnings
    taken: set[str] = set()
    for _, _, term, weight in sorted(rated):
        stem = term.rstrip(" ")
        if stem in beginnings or any(stem[:n] in taken for n in range(5, len(stem) + 1)):
            continue
        chosen.append((term, weight))
        taken.add(stem)
        beginnings.update(stem[:n] for n in range(5, len(stem) + 1))
        if len(chosen) == MAX_TERMS:
            break
    return chosen


def logistic(x: np.ndarray, y: np.ndarray, prior: tuple[float, ...], ridge: float = 1.0) -> np.ndarray:
    """Newton's method from, and held with ``ridge`` to, the ``prior``."""
    center = np.array(prior)
    w = center.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (y - p) - ridge * (w - center))
        w += np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(
    docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000, seeds: tuple[str, ...] = SEED_TERMS
) -> ToxicityModel:
    """Learn lexicon and curve from ``docs`` (doc_id, text) and ``labels``
    (doc_id, toxic); the caller has left out the labels that must not be seen."""
    spark = docs.sparkSession
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_labelled)
    )
    # at most max_labelled rows of two numbers: a bounded broadcast
    sample = documents(docs).join(F.broadcast(chosen), "doc_id").select("text", "toxic")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, Counter] = {0: Counter(), 1: Counter()}

        def flush() -> pa.RecordBatch:
            keys = list(seen[0].keys() | seen[1].keys())
            columns = [[seen[k][t] for t in keys] for k in (1, 0)]
            for c in seen.values():
                c.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), *(pa.array(c, pa.int64()) for c in columns)],
                names=["term", "toxic", "clean"],
            )

        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                terms = terms_of(fold(text.as_py()))
                seen[int(toxic > 0)].update(terms | {""})
                if len(seen[0]) + len(seen[1]) > 500_000:
                    yield flush()
        if seen[0] or seen[1]:
            yield flush()

    counts = (
        sample.mapInArrow(count, "term string, toxic long, clean long")
        .groupBy("term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )
    # the terms that fit toxic texts best, and the totals under the empty term
    lift = (F.col("toxic") + 0.5) / (F.col("clean") + 0.5)
    is_seed = F.col("term").isin([f" {t} " for t in seeds])
    best = (
        counts.where((F.col("toxic") >= MIN_DOCS) | (F.col("term") == "") | is_seed)
        .orderBy(F.col("term") != "", ~is_seed, F.desc(F.log(lift) * F.col("toxic")), "term")
        .limit(20 * MAX_TERMS)
        .collect()
    )
    totals = {r.term: (r.toxic, r.clean) for r in best}
    toxic, clean = totals.pop("", (0, 0))
    terms = choose_terms([(t, a, b) for t, (a, b) in totals.items()], toxic, clean) if toxic and clean else []
    terms += [(f" {t} ", SEED_WEIGHT) for t in seeds if f" {t} " not in totals]
    draft = ToxicityModel(tuple(terms), (0.0, 0.0, 0.0))

    @F.pandas_udf("weight double, words long")
    def weigh(texts):  # noqa: ANN001, ANN202
        import pandas as pd

        return pd.DataFrame([draft.weigh(t) for t in texts], columns=["weight", "words"])

    rows = sample.select(weigh("text").alias("w"), "toxic").select("w.weight", "w.words", "toxic").collect() if toxic and clean else []
    if not rows:
        return ToxicityModel(draft.terms, CURVE)
    x = np.array([(1.0, *features(r.weight, r.words)) for r in rows])
    y = np.array([float(r.toxic > 0) for r in rows])
    return ToxicityModel(draft.terms, tuple(float(v) for v in logistic(x, y, CURVE)))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are never learnt from: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("long").cast("string")) % 4 == 2, F.lit(False))


def fit_on_labels(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000) -> ToxicityModel:
    """``fit`` on the labels that are not held out, without seed terms."""
    return fit(docs, labels.where(~held_out()), max_labelled, seeds=())
