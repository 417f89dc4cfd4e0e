"""SimHash classes against a brute-force pass over all pairs."""

from __future__ import annotations

import random

import xxhash
from pyspark.sql import functions as F

from martlet.llm import simhash
from martlet.llm.catalog import QUERIES
from martlet.llm.common import connected_components, table

SF = "/root/testdata/sf0.001"


def brute_fingerprint(text, k=4):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(items, d=4):
    """item index -> smallest reachable id"""
    parent = list(range(len(items)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(items)):
        for j in range(i):
            if (items[i][1] ^ items[j][1]).bit_count() <= d:
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(items):
        r = find(i)
        least[r] = min((x for x in (least.get(r), doc) if x is not None), default=None)
    return [least[find(i)] for i in range(len(items))]


def test_query(spark):
    rows = [(r.doc_id, brute_fingerprint(r.text)) for r in table(spark, SF, "documents").collect()]
    want = {(d, f"{f:016x}", c) for (d, f), c in zip(rows, brute_classes(rows))}
    got = QUERIES["op9_simhash"](spark, SF).collect()
    assert len(got) == len(rows) and {(r.doc_id, r.fingerprint, r.component_id) for r in got} == want


def test_links_on_planted_fingerprints(spark):
    rng = random.Random(5)
    fps = {0, (1 << 64) - 1}
    for _ in range(40):
        base = rng.getrandbits(64)
        fps |= {base ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(7))) for _ in range(8)}
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    for d in (1, 2, 3, 4, 6):
        got = simhash.linked_fingerprints(spark.createDataFrame(signed, "fp long"), d).collect()
        want = {(a, b) for (a,) in signed for (b,) in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= d}
        assert len(got) == len(want) and {(r.u, r.v) for r in got} == want


def test_odd_rows(spark):
    rows = [(5, None), (4, ""), (None, "a b c d e f"), (8, "A  B\tc d e f"), (8, "a b c d e f"), (2, "two words"),
            (9, "é É ÄB"), (10, "word " * 70_000), (11, " "), (3, " \n ")]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, fp int, root int")
    items = [(i, brute_fingerprint(t)) for i, t in rows]
    got = simhash.near_duplicates(df).collect()
    want = [(d, f - (1 << 64) if f >> 63 else f, c) for (d, f), c in zip(items, brute_classes(items))]
    key = lambda t: tuple((x is not None, x) for x in t)
    assert sorted(((r.doc_id, r.fp, r.component_id) for r in got), key=key) == sorted(want, key=key)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect())) == sorted({c for _, _, c in want})
    assert simhash.near_duplicates(df.where("false")).count() == 0
    assert simhash.keep_one(df.where("false")).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 40)] + [(39, 3), (5, 5), (8, 7)]
    got = connected_components(spark.createDataFrame(edges, "u long, v long"))
    assert {(r.node, r.root) for r in got.collect()} == (
        {(i, 100) for i in range(100, 161)} | {(i, 3) for i in [3, *range(7, 40)]}
    )


def test_vector_distance_is_a_lower_bound(spark):
    df = spark.range(200).select(F.xxhash64("id").alias("a"), F.xxhash64(F.col("id") + 1000).alias("b"))
    for r in df.select("a", "b", simhash.popcount_vector(F.col("a")).alias("va"),
                       simhash.popcount_vector(F.col("b")).alias("vb")).collect():
        parts = lambda v: [v >> 2 * s & 3 for s in range(32)]
        assert sum(abs(x - y) for x, y in zip(parts(r.va), parts(r.vb))) <= ((r.a ^ r.b) & (1 << 64) - 1).bit_count()
