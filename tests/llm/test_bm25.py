"""BM25 against scoring every document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from martlet.llm import bm25
from martlet.llm.catalog import QUERIES
from martlet.llm.common import scratch, table

SF = "/root/testdata/sf0.001"


def brute(docs, k=10, every=50):
    """docs: (id, text) -> {(query id, query text): [(score, id)]}"""
    bags = [(i, Counter(re.findall(r"[^\W_]+", (t or "").lower()))) for i, t in docs]
    n, mean = len(bags), sum(sum(b.values()) for _, b in bags) / max(1, len(bags))
    df = Counter(t for _, b in bags for t in b)
    out = {}
    for (q, text), (_, bag) in zip(docs, bags):
        if q is None or q % every:
            continue
        hits = []
        for i, b in bags:
            norm = bm25.K1 * (1 - bm25.B + bm25.B * sum(b.values()) / max(mean, 1e-9))
            s = sum(
                math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * b[t] * (bm25.K1 + 1) / (b[t] + norm) for t in bag if t in b
            )
            if s > 0:
                hits.append((s, i))
        out[q, text or ""] = sorted(hits, key=lambda h: (-round(h[0], 6), h[1] is None, h[1] or 0))[:k]
    return out


def check(got, want):
    by = {}
    for r in got:
        by.setdefault((r.query_id, r.query_tie), []).append(r)
    lists = sorted(
        (q, [(round(r.score, 6), r.doc_id) for r in sorted(rows, key=lambda r: r["rank"])]) for (q, _), rows in by.items()
    )
    assert lists == sorted((q, [(round(s, 6), i) for s, i in hits]) for (q, _), hits in want.items() if hits)


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    check(QUERIES["op8_bm25"](spark, SF).collect(), brute(docs))


@pytest.mark.parametrize("postings", [40, 700, 10**6])
def test_many_small_shards(spark, postings, monkeypatch):
    monkeypatch.setattr(bm25, "BLOCK_DOCS", 4)
    rng = random.Random(postings)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(4000)]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 30)))) for i in range(300)]
    path = scratch(spark, "t")
    bm25.build_index(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), path, shard_postings=postings)
    check(bm25.search(path, bm25.self_queries(spark, path, 20), 7).collect(), brute(docs, 7, 20))


def test_odd_rows(spark):
    docs = [(0, None), (50, ""), (100, "a b"), (100, "a b"), (100, "b c"), (None, "a b"), (7, "A, b! a_b"), (8, "x"), (150, "zz " * 50_000)]
    df = spark.createDataFrame([(i, t, 1, 2, "s") for i, t in docs], "doc_id long, text string, terms int, shard int, tie string")
    path = scratch(spark, "t")
    bm25.build_index(df.coalesce(1), path)
    check(bm25.search(path, bm25.self_queries(spark, path), 10).collect(), brute(docs))
    path = scratch(spark, "t")
    bm25.build_index(df.where("false"), path)
    assert bm25.search(path, bm25.self_queries(spark, path), 10).count() == 0


def test_rows_do_not_grow_with_shards(spark):
    rng = random.Random(5)
    docs = [(i, " ".join(f"w{int(rng.paretovariate(0.7))}" for _ in range(20))) for i in range(400)]
    path = scratch(spark, "t")
    bm25.build_index(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), path, shard_postings=40)
    shards = bm25.read_index(spark, path).select("shard").distinct().count()
    assert shards > 5 * bm25.SHARD_GROUPS
    found = bm25.search(path, bm25.self_queries(spark, path, 4), 7)
    check(found.collect(), brute(docs, 7, 4))
    assert bm25.group_best(path, bm25.self_queries(spark, path, 4), 7).count() <= 100 * 7 * bm25.SHARD_GROUPS


def test_matrix_postings_and_copies(spark, monkeypatch):
    """Frequent terms and rare ones, close scores, more copies than ranks, cuts of every kind."""
    rng = random.Random(6)
    common, rare = [f"c{i}" for i in range(12)], [f"r{i}" for i in range(900)]
    docs = [(i, " ".join(rng.sample(common, 6) + rng.choices(rare, k=rng.randrange(0, 9)) + [f"f{i}"] * i)) for i in range(1, 500)]
    docs += [(500 + i * 7 % 60, " ".join(common)) for i in range(60)] + [(None, " ".join(common))] * 3
    docs += [(600 + i, " ".join(common * 40) + " c0" * i) for i in range(40)]
    path = scratch(spark, "t")
    monkeypatch.setattr(bm25, "BLOCK_DOCS", 150)
    monkeypatch.setattr(bm25, "LEAST_QUERIES", 16)
    monkeypatch.setattr(bm25, "SCORED_QUERIES", 5)
    monkeypatch.setattr(bm25, "SCORED_POSTINGS", 60)
    monkeypatch.setattr(bm25, "MATRIX_TERMS", 9)
    bm25.build_index(spark.createDataFrame(docs, "doc_id long, text string").repartition(2), path, shard_postings=2_000)
    check(bm25.search(path, bm25.self_queries(spark, path, 5), 6).collect(), brute(docs, 6, 5))


def test_queries_of_one_language_are_scored_together():
    """They share frequent terms, so a product needs only the rows of these."""
    rng = random.Random(7)
    terms, starts = [], [0]
    for i in range(60):
        own = [1_000 * (i % 3) + t for t in rng.sample(range(20), 12)]
        terms += sorted(own + [9_000 + t for t in rng.sample(range(50), 3)])
        starts.append(len(terms))
    queries = bm25.Queries(list(range(60)), [0] * 60, np.array(starts), np.array(terms), np.array(terms) / 10_000)
    assert sorted(queries.ids) == list(range(60))
    assert sum(a % 3 != b % 3 for a, b in zip(queries.ids, queries.ids[1:])) < bm25.ALIKE
    for at, i in enumerate(queries.ids):
        numbers = queries.number[queries.starts[at] : queries.starts[at + 1]]
        assert queries.distinct[numbers].tolist() == terms[starts[i] : starts[i + 1]]
        assert (queries.idf[numbers] * 10_000).round().tolist() == terms[starts[i] : starts[i + 1]]


def test_rows_and_lists_are_chosen_for_each_batch(spark, monkeypatch):
    """Two languages, frequent terms that few queries have, and scores that tie."""
    rng = random.Random(8)
    words = [[f"{lang}{i}" for i in range(40)] for lang in "xy"] + [[f"ñ{i}" for i in range(40)]]
    docs = [(i, " ".join(rng.sample(words[i % 3], 15) + [f"m{i % 11}", f"R{i % 37}"])) for i in range(600)]
    docs += [(600 + i, " ".join([*words[0][:10], f"u{i}", f"v{i}"])) for i in range(40)]
    monkeypatch.setattr(bm25, "BLOCK_DOCS", 200)
    monkeypatch.setattr(bm25, "LEAST_QUERIES", 16)
    for worth in (0.0, 0.05, 2.0):
        monkeypatch.setattr(bm25, "WORTH", worth)
        path = scratch(spark, "t")
        bm25.build_index(spark.createDataFrame(docs, "doc_id long, text string").repartition(2), path, shard_postings=4_000)
        check(bm25.search(path, bm25.self_queries(spark, path, 5), 6).collect(), brute(docs, 6, 5))


def test_words_of_ascii_texts():
    rng = random.Random(9)
    for _ in range(300):
        text = "".join(chr(rng.randrange(128)) for _ in range(60))
        length, terms, counts = bm25.terms_of(text)
        wide = bm25.terms_of(text + " é")
        assert length == len(re.findall(r"[^\W_]+", text.lower())) == wide[0] - 1
        assert set(zip(terms.tolist(), counts.tolist())) < set(zip(wide[1].tolist(), wide[2].tolist()))


def test_order_of_terms():
    rng = np.random.default_rng(10)
    for terms in (rng.integers(-(2**63), 2**63 - 1, 5_000), rng.integers(-9, 9, 5_000), np.zeros(0, np.int64)):
        order, in_order = bm25._order(terms)
        assert (terms[order] == in_order).all() and (in_order == np.sort(terms)).all()
        assert sorted(order) == list(range(len(terms)))
