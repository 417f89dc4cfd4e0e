"""Vector codes against a version in Python integers."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from martlet.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<float>, label int, vector string, code int, `of` int, total int"


def brute(rows, parts=8, entries=16, rounds=6):
    """{(id, code, error, label error)}, hash; rows are (id, vector, label)."""
    kept = []
    for i, v, label in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(4096 * float(np.float32(x))) for x in v], label))
    if not kept:
        return [], None
    width = -(-max(len(v) for _, v, _ in kept) // parts)
    kept = [(i, v + [0] * (width * parts - len(v)), label) for i, v, label in kept]
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]

    def cut(v, p):
        return v[p * width : (p + 1) * width]

    books = [[cut(v, p) for _, v, _ in order] for p in range(parts)]

    def assign():
        out = []
        for _, v, _ in kept:
            row = []
            for p in range(parts):
                d = [sum((a - b) ** 2 for a, b in zip(cut(v, p), e)) for e in books[p]]
                row.append((min(d), d.index(min(d))))
            out.append(row)
        return out

    for _ in range(rounds):
        got = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [cut(v, p) for (_, v, _), row in zip(kept, got) if row[p][1] == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    got = assign()
    by = {}
    for (_, _, label), row in zip(kept, got):
        by[label] = by.get(label, 0) + sum(d for d, _ in row)
    top = 2**63 - 1
    rows = [
        (i, "".join(f"{e:02x}" for _, e in row), min(top, sum(d for d, _ in row)), min(top, by[label]))
        for (i, _, label), row in zip(kept, got)
    ]
    return rows, hashlib.sha256(",".join(str(x) for part in books for e in part for x in e).encode()).hexdigest()


def rows_of(df):
    got = df.collect()
    hashes = {r.codebooks_sha256 for r in got}
    assert len(hashes) <= 1
    return [(r.vec_id, r.code, r.error, r.label_error) for r in got], next(iter(hashes), None)


def check(spark, rows, partitions=3):
    wide = [(i, v, label, "x", 1, 2, 3) for i, v, label in rows]
    got, found = rows_of(V.compress(spark.createDataFrame(wide, SCHEMA).repartition(partitions)))
    want, hashed = brute(rows)
    key = str
    assert sorted(got, key=key) == sorted(want, key=key) and found == hashed


def vectors(rng, n, size, spread=1.0):
    return [(i, [rng.gauss(0, spread) for _ in range(size)], rng.choice([0, 1, None])) for i in range(n)]


def test_random_vectors(spark):
    check(spark, vectors(random.Random(1), 60, 16))


def test_defined_cases(spark):
    rng = random.Random(2)
    rows = vectors(rng, 30, 12)  # 12 is no multiple of 8
    rows += [(100, None, 1), (101, [None] * 12, 1), (102, [1.0, float("nan")], 1), (103, [float("inf")] * 12, 1)]
    rows += [(None, [0.5] * 12, 2), (3, [-0.25] * 12, 2), (3, [-0.25] * 12, 2), (104, [], 5), (105, [0.1] * 3, 5)]
    check(spark, rows)


def test_few_rows_and_ties(spark):
    check(spark, [(2, [1.0, -1.0] * 4, 7), (1, [1.0, -1.0] * 4, 7), (9, [0.0] * 8, None)], partitions=1)


def test_large_components(spark):
    rng = random.Random(3)
    check(spark, vectors(rng, 25, 8, 1e5))  # two limbs
    huge = vectors(rng, 20, 8, 1.0) + [(50 + i, [rng.uniform(-3e38, 3e38) for _ in range(8)], 4) for i in range(4)]
    check(spark, huge)


def test_empty_tables(spark):
    assert V.compress(spark.createDataFrame([], SCHEMA)).count() == 0
    nothing = V.compress(spark.createDataFrame([(1, None, 1, "x", 1, 2, 3)], SCHEMA))
    assert nothing.count() == 0 and "codebooks_sha256" in nothing.columns
    blank = V.compress(spark.createDataFrame([(1, [], 1, "x", 1, 2, 3)], SCHEMA)).collect()
    assert [(r.code, r.error) for r in blank] == [("00" * 8, 0)]


@pytest.mark.parametrize("top", [2**12, 2**25, 2**29, 2**70])
def test_exact_products(top):
    rng = random.Random(top)
    a = [[rng.randrange(-top, top) >> 30 << 30 if top > 2**50 else rng.randrange(-top, top) for _ in range(8)] for _ in range(20)]
    b = [[rng.randrange(-top, top) for _ in range(8)] for _ in range(16)]
    bits = V.limb_bits(8)
    assert 8 * (2**bits) ** 2 <= 2**53
    x = np.array(a, dtype=np.float64)
    a = [[int(v) for v in row] for row in x]
    got = V.exact_products(V.float_limbs(x, bits), V.int_limbs([v for r in b for v in r], (16, 8), bits), bits, top > 2**29)
    assert [[int(v) for v in row] for row in got] == [[sum(p * q for p, q in zip(r, s)) for s in b] for r in a]
    squares = V.exact_squares(V.float_limbs(x, bits), bits, top > 2**29)
    assert [int(v) for v in squares] == [sum(v * v for v in r) for r in a]


def test_a_hot_label_and_partitioning_change_nothing(spark):
    df = spark.createDataFrame(
        [(i, v, 1 if i % 3 else i) for i, v, _ in vectors(random.Random(5), 80, 8)], "vec_id long, embedding array<float>, label int"
    )
    one, many = rows_of(V.compress(df.coalesce(1))), rows_of(V.compress(df.repartition(7)))
    assert sorted(one[0]) == sorted(many[0]) and one[1] == many[1]
    assert V.compress(df.withColumnRenamed("embedding", "e"), vector_col="e", parts=4, entries=5, rounds=0).agg(
        F.max(F.length("code"))
    ).first()[0] == 8
