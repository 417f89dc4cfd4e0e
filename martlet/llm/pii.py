"""Personal data: validated spans, and look-alikes chosen by boosted trees.

Validated spans (e-mail, IPv4, card, phone) always stand. High-recall
generators propose further, overlapping spans: digit groups of any layout and each
short sequence of neighbouring groups, addresses spelt out or without a domain dot,
IBAN-like and IPv6-like strings. Gradient-boosted trees score every proposal by its
format and context; thresholds per generator, calibrated on documents the trees
have not seen, select the ones to redact (a generator with few genuine examples
goes by the threshold over all of them).

Positive examples are the proposals that are a validated span or pass their kind's
own test (card checksum, IBAN remainder, readable IPv6 address, an e-mail address
once spelt-out signs are written); all other proposals are negative. The tests are
not features, so the score says how much a proposal looks like, and stands like,
personal data. Trees and thresholds are fitted on the proposals of all documents, in
Spark; equal proposals are one weighted row. (Where the examples fill several tasks,
sums of doubles are added in the order in which these end, which may choose another of
two equally good splits.) Host names are read up to ``MAX_HOST`` characters.

Defined cases: a null text is empty and has no spans; repeated rows give equal
results; texts are searched whole, in time linear in their length; without
both kinds of examples, or where no threshold reaches the precision asked for,
nothing is added to the validated spans. Other columns are not read.
"""

from __future__ import annotations

import bisect
import hashlib
import ipaddress
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from martlet.llm.common import documents, staged

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("digits", "address", "iban", "ipv6")
KINDS = BASE_KINDS + ADDED_KINDS

# The fixed patterns of the validated kinds.
EMAIL_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

DIGIT = re.compile(r"[0-9]")
GROUP = re.compile(r"[0-9]+")
#: Digits of a phone or card number, and the most groups they are written in.
MIN_DIGITS, MAX_DIGITS, MAX_GROUPS = 7, 19, 7
#: Calibration examples of a kind that must be genuine for a threshold of its own.
LEAST_POSITIVES = 10
#: Different training examples a task holds, and bins a unit of raw score.
TASK_EXAMPLES, SCORE_BINS = 50_000, 256
DIGIT_GROUPS = re.compile(r"[0-9](?:[\x20()./-]{0,2}[0-9]){5,}")
SPELT_ADDRESS = re.compile(r"[\[(]at[\])]|@", re.IGNORECASE)
SPELT_AT = re.compile(r"\s?[\[(]at[\])]\s?", re.IGNORECASE)
SPELT_DOT = re.compile(r"\s?[\[(]dot[\])]\s?", re.IGNORECASE)
#: Longest host name looked at after an @.
MAX_HOST = 253
HOST = re.compile(r"[\w-]+(?:(?:\.|\s?[\[(]dot[\])]\s?)[\w-]+)*", re.IGNORECASE)
IBAN = re.compile(r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b")
IPV6 = re.compile(r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::{1,2}[0-9A-Fa-f]{1,4}){3,7}(?![0-9A-Fa-f:])")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @ and dotted domain; each local part is
    walked once, so no run of its characters is tried from every start."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in EMAIL_LOCAL:
            start -= 1
        domain = EMAIL_DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        free = domain.end() if domain else at + 1
        at = text.find("@", free)


def addresses_v4(text: str) -> Iterator[tuple[int, int]]:
    """Four dotted numbers at a time along each dotted chain, parts up to 255."""
    for chain in IP_CHAIN.finditer(text):
        if chain[0].count(".") < 3:
            continue
        parts, at = chain[0].split("."), chain.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield at, end
            at = end + 1


def validated(text: str) -> list[Span]:
    """The validated spans, by kind as listed, then start."""
    out = [("email", a, b) for a, b in emails(text)]
    if not DIGIT.search(text):
        return out
    out += [("ip", a, b) for a, b in addresses_v4(text)]
    for m in CARD.finditer(text):
        digits = only_digits(m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(only_digits(m[0])) <= 15]
    return out


def digit_proposals(text: str, start: int, end: int) -> Iterator[Span]:
    """Of a run of digit groups, however long: each group of many digits, and each
    sequence of up to ``MAX_GROUPS`` neighbouring groups that has as many digits as
    a phone or card number."""
    groups = [m.span() for m in GROUP.finditer(text, start, end)]
    for i, (a, b) in enumerate(groups):
        from_plus = a - (a > 0 and text[a - 1] == "+")
        if b - a > MAX_DIGITS:
            yield "digits", from_plus, b
            continue
        digits = 0
        for c, d in groups[i : i + MAX_GROUPS]:
            digits += d - c
            if digits > MAX_DIGITS:
                break
            if digits >= MIN_DIGITS:
                yield "digits", from_plus, d


def genuine(text: str, span: Span) -> bool:
    """The added kinds' own tests, which label examples and are no features: a card
    checksum, an IBAN's remainder, a readable IPv6 address, an e-mail address once
    what is spelt out is written as signs."""
    kind, body = span[0], text[span[1] : span[2]]
    if kind == "digits":
        digits = only_digits(body)
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "iban":
        bare = body.replace(" ", "")
        return int("".join(str(int(c, 36)) for c in bare[4:] + bare[:4])) % 97 == 1
    if kind == "ipv6":
        try:
            return bool(ipaddress.IPv6Address(body))
        except ValueError:
            return False
    written = SPELT_DOT.sub(".", SPELT_AT.sub("@", body))
    return kind == "address" and bool(re.fullmatch(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", written))


def proposed(text: str) -> list[Span]:
    """High-recall proposals beside the validated spans; they may overlap."""
    out: list[Span] = []
    if DIGIT.search(text):
        for m in DIGIT_GROUPS.finditer(text):
            out += digit_proposals(text, *m.span())
        out += [("iban", *m.span()) for m in IBAN.finditer(text)]
    free = 0
    for m in SPELT_ADDRESS.finditer(text):
        start = m.start()
        if start > free and text[start - 1] == " " and m[0] != "@":
            start -= 1
        left = start
        while left > free and text[left - 1] in EMAIL_LOCAL:
            left -= 1
        skip = m.end() + (text[m.end() : m.end() + 1] == " " and m[0] != "@")
        host = HOST.match(text, skip, skip + MAX_HOST)
        if left < start and host:
            out.append(("address", left, host.end()))
        free = m.end()
    if ":" in text:
        out += [("ipv6", *m.span()) for m in IPV6.finditer(text)]
    return out


FEATURES = (
    "kind", "length", "digits", "letters", "separators", "groups", "longest_group", "first_group",
    "upper_share", "plus", "dots", "dashes", "spaces", "before", "after", "word_before", "word_after",
    "colon_before", "cue_before", "run_groups", "groups_before", "groups_over",
)
#: Words before a span that announce personal data.
CUES = re.compile(r"(?i)(mail|tel|phone|fon|call|contact|card|karte|iban|account|konto|id|ssn|ip|host)\W*$")


def _char_class(c: str) -> float:
    return 0.0 if not c else 1.0 if c.isspace() else 2.0 if c.isdigit() else 3.0 if c.isalpha() else 4.0


def group_places(text: str) -> dict[int, tuple[int, int]]:
    """Where each digit group of a run begins -> groups of the run before it and in all."""
    out = {}
    for m in DIGIT_GROUPS.finditer(text):
        starts = [g.start() for g in GROUP.finditer(text, *m.span())]
        out.update((at, (i, len(starts))) for i, at in enumerate(starts))
    return out


def describe(text: str, span: Span, places: dict[int, tuple[int, int]]) -> list[float]:
    """Format and context of a proposal, in the order of ``FEATURES``; ``places``
    tells how it divides the run of digit groups it stands in."""
    kind, a, b = span
    body, left, right = text[a:b], text[max(0, a - 24) : a], text[b : b + 24]
    groups = [len(g) for g in re.findall(r"[0-9]+", body)] or [0]
    earlier, run = places.get(a + (body[:1] == "+"), (0, len(groups)))
    letters = sum(map(str.isalpha, body))
    digits = sum(groups)
    return [
        float(KINDS.index(kind)), float(b - a), float(digits), float(letters), float(b - a - digits - letters),
        float(len(groups)), float(max(groups)), float(groups[0]),
        sum(map(str.isupper, body)) / max(1, letters), float(body[:1] == "+"), float(body.count(".")),
        float(body.count("-")), float(body.count(" ")), _char_class(text[a - 1 : a] if a else ""),
        _char_class(right[:1]), float(len(re.search(r"\w*\W*$", left)[0])), float(len(re.match(r"\W*\w*", right)[0])),
        float(left.rstrip()[-1:] in (":", "=")), float(bool(CUES.search(left))),
        float(min(run, 32)), float(earlier % len(groups)), float(run % len(groups)),
    ]


def confirmed(span: Span, held: list[tuple[int, int]]) -> bool:
    """The proposal is a validated span: they share nine tenths of their extent.
    ``held`` are the validated extents, sorted."""
    _, start, end = span
    at = bisect.bisect_left(held, (end,)) - 1
    # an extent that begins further left can't share so much
    while at >= 0 and held[at][0] >= start - (end - start):
        a, b = held[at]
        if min(b, end) - max(a, start) >= 0.9 * (max(b, end) - min(a, start)):
            return True
        at -= 1
    return False


@dataclass(frozen=True)
class BoostedTrees:
    """Arrays of every tree's nodes; feature -1 marks a leaf."""

    trees: tuple[tuple[float, tuple[tuple[int, float, int, int, float], ...]], ...] = ()

    def raw(self, x: list[float]) -> float:
        total = 0.0
        for weight, nodes in self.trees:
            feature, threshold, left, right, value = nodes[0]
            while feature >= 0:
                feature, threshold, left, right, value = nodes[left if x[feature] <= threshold else right]
            total += weight * value
        return total


@dataclass(frozen=True)
class PiiModel:
    trees: BoostedTrees = BoostedTrees()
    #: kind -> least raw score that is redacted
    thresholds: tuple[tuple[str, float], ...] = ()

    def spans(self, text: str) -> list[Span]:
        """Validated spans and the chosen proposals that add to them, by kind
        as listed, then start."""
        base = validated(text)
        limits = dict(self.thresholds)
        added = set()
        if limits:
            held = sorted((a, b) for _, a, b in base)
            places = group_places(text) if DIGIT.search(text) else {}
            for span in proposed(text):
                if span[0] not in limits or confirmed(span, held) or _inside(span, held):
                    continue
                if self.trees.raw(describe(text, span, places)) >= limits[span[0]]:
                    added.add(span)
        return base + sorted(added, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))

    def redact(self, text: str) -> str:
        """Every run of overlapping spans replaced by its first span's kind."""
        out, at = [], 0
        for kind, a, b in sorted(self.spans(text), key=lambda s: (s[1], -s[2])):
            if a >= at:
                out += [text[at:a], f"[{kind.upper()}]"]
            at = max(at, b)
        return "".join(out) + text[at:]


def _inside(span: Span, held: list[tuple[int, int]]) -> bool:
    i = bisect.bisect_right(held, (span[1], 1 << 62)) - 1
    return i >= 0 and held[i][1] >= span[2]


def _tree_nodes(root) -> tuple[tuple[int, float, int, int, float], ...]:  # noqa: ANN001
    nodes: list[tuple[int, float, int, int, float]] = []

    def walk(node) -> int:  # noqa: ANN001
        at = len(nodes)
        nodes.append((-1, 0.0, -1, -1, node.prediction()))
        if node.subtreeDepth() > 0:
            split = node.split()
            feature, threshold = split.featureIndex(), split.threshold()
            left, right = walk(node.leftChild()), walk(node.rightChild())
            nodes[at] = (feature, threshold, left, right, 0.0)
        return at

    walk(root)
    return tuple(nodes)


def examples(docs: DataFrame) -> DataFrame:
    """(kind, calibration, label, x) of every proposal of every document of ``docs``,
    the validated e-mail and IPv4 spans as their generators would propose them."""
    kinds = [pa.string(), pa.bool_(), pa.float64(), pa.list_(pa.float64())]
    names = ["kind", "calibration", "label", "x"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for text in batch.column(0):
                text = text.as_py()
                base = validated(text)
                found = [*proposed(text), *(b for b in base if b[0] in ("email", "ip"))]
                if not found:
                    continue
                held = sorted((a, b) for _, a, b in base)
                places = group_places(text) if DIGIT.search(text) else {}
                side = int(hashlib.md5(text.encode("utf-8", "replace")).hexdigest()[:4], 16) % 3 == 0
                for s in found:
                    if s[0] in ("email", "ip"):
                        s = ("address" if s[0] == "email" else "digits", s[1], s[2])
                    rows.append((s[0], side, float(confirmed(s, held) or genuine(text, s)), describe(text, s, places)))
                    if len(rows) >= 5_000:
                        yield batch_of(rows)
                        rows = []
        if rows:
            yield batch_of(rows)

    return documents(docs).select("text").mapInArrow(run, "kind string, calibration boolean, label double, x array<double>")


def fit(docs: DataFrame, precision: float = 0.9, seed: int = 7) -> PiiModel:
    """Fit trees and thresholds on the proposals of all documents. Only the trees
    and a threshold a kind reach the driver."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    # equal examples are one row with a weight, so copies of a text make no large partition
    alike = ["kind", "calibration", "label", "x"]
    rows = staged(examples(docs).groupBy(*alike).agg(F.count(F.lit(1)).cast("double").alias("weight")), "pii-examples")
    train = rows.where("not calibration")
    labels = [r["n"] for r in train.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()]  # two rows
    if len(labels) < 2:
        return PiiModel()
    # the same partitions in the same order, however the documents lie
    order = [F.xxhash64("kind", "label", "x", F.lit(seed)), F.col("kind"), F.col("label"), F.col("x")]
    train = train.repartition(-(-sum(labels) // TASK_EXAMPLES), *order[1:]).sortWithinPartitions(*order)
    train = train.select("label", "weight", array_to_vector("x").alias("features"))
    fitted = GBTClassifier(maxIter=16, maxDepth=4, stepSize=0.3, seed=seed, weightCol="weight").fit(train)
    trees = BoostedTrees(
        tuple((float(w), _tree_nodes(t._java_obj.rootNode())) for w, t in zip(fitted.treeWeights, fitted.trees))
    )
    found = thresholds(scored(rows.where("calibration"), trees), precision)
    # a kind without enough examples of its own goes by those of all kinds
    pooled = found.get(None, (0.0, None))[1]
    limits = []
    for kind in ADDED_KINDS:
        positives, limit = found.get(kind, (0.0, None))
        limit = limit if positives >= LEAST_POSITIVES else pooled
        if limit is not None:
            limits.append((kind, limit))
    return PiiModel(trees, tuple(limits))


def scored(rows: DataFrame, trees: BoostedTrees) -> DataFrame:
    """(kind, label, weight, score) of examples."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = pa.array([trees.raw(x) for x in batch.column("x").to_pylist()], pa.float64())
            columns = [batch.column("kind"), batch.column("label"), batch.column("weight"), score]
            yield pa.RecordBatch.from_arrays(columns, names=["kind", "label", "weight", "score"])

    return rows.mapInArrow(run, "kind string, label double, weight double, score double")


def thresholds(examples: DataFrame, precision: float, least: int = 10) -> dict[str | None, tuple[float, float | None]]:
    """kind (None: all kinds together) -> (positive examples, ``threshold`` over all
    its examples), from (kind, label, weight, score). Counts run over bins of the
    score first and then within a bin, so no task orders all scores of a kind."""
    kinds = F.explode(F.array("kind", F.lit(None).cast("string"))).alias("kind")
    hits = F.sum(F.col("label") * F.col("weight"))
    ties = examples.select(kinds, "label", "weight", "score").groupBy("kind", "score")
    ties = ties.agg(F.sum("weight").alias("n"), hits.alias("hits"))
    ties = staged(ties.withColumn("bin", F.floor(F.col("score") * SCORE_BINS)), "pii-scores")
    # scores lie within a few units of 0: some thousand bins at most
    above = W.partitionBy("kind").orderBy(F.desc("bin")).rowsBetween(W.unboundedPreceding, -1)
    bins = ties.groupBy("kind", "bin").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))
    bins = bins.select(
        F.col("kind").alias("_kind"),
        F.col("bin").alias("_bin"),
        *[F.coalesce(F.sum(c).over(above), F.lit(0.0)).alias(f"{c}_above") for c in ("n", "hits")],
    )
    within = W.partitionBy("kind", "bin").orderBy(F.desc("score")).rowsBetween(W.unboundedPreceding, 0)
    n, right = (F.col(f"{c}_above") + F.sum(c).over(within) for c in ("n", "hits"))
    running = ties.join(bins, F.col("kind").eqNullSafe(F.col("_kind")) & (F.col("bin") == F.col("_bin")))
    running = running.select("kind", "score", "hits", n.alias("so_far"), right.alias("right"))
    enough = (F.col("so_far") >= least) & (F.col("right") >= F.lit(precision) * F.col("so_far"))
    lowest = running.groupBy("kind").agg(F.sum("hits").alias("hits"), F.min(F.when(enough, F.col("score"))).alias("limit"))
    return {r.kind: (r.hits, r.limit) for r in lowest.collect()}  # a row a kind


def threshold(pairs: list[tuple[float, float]], precision: float, least: int = 10) -> float | None:
    """The lowest score at or above which ``precision`` of the examples are
    positive, over at least ``least`` of them (``thresholds`` does so for a table)."""
    best, hits = None, 0.0
    ordered = sorted(pairs, key=lambda p: -p[0])
    for n, (score, label) in enumerate(ordered, 1):
        hits += label
        last_of_ties = n == len(ordered) or ordered[n][0] < score
        if last_of_ties and n >= least and hits >= precision * n:
            best = score
    return best


def find(docs: DataFrame, model: PiiModel) -> DataFrame:
    """(doc_id, spans: array of kind, start, end) for every row of ``docs``;
    offsets count code points, ends are exclusive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            found = [
                [{"kind": k, "start": a, "end": b} for k, a, b in model.spans(text.as_py())] for text in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], names=["doc_id", "spans"])

    return documents(docs).mapInArrow(run, "doc_id long, spans array<struct<kind:string,start:int,end:int>>")


def redacted_column(text: Column, model: PiiModel) -> Column:
    @F.pandas_udf("string")
    def of(texts):  # noqa: ANN001, ANN202
        return texts.map(lambda t: t if t is None else model.redact(t))

    return of(text.cast("string"))


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined, in the order given."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
