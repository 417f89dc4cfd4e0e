"""Tiles by counting equal NTILE over the whole table."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from martlet.operators.selection import Ranking, with_tiles

SCHEMA = "k long, a long, d decimal(38,2), x string"
RANKINGS = [Ranking("a", "up"), Ranking("a", "down", descending=True), Ranking("d", "amount")]


def _both(spark, rows, buckets, bins):
    df = spark.createDataFrame(rows, SCHEMA)
    orders = {
        "up": [F.asc_nulls_first("a"), F.asc("k")],
        "down": [F.desc_nulls_last("a"), F.asc("k")],
        "amount": [F.asc_nulls_first("d"), F.asc("k")],
    }
    want = df.select("k", *[F.ntile(buckets).over(W.orderBy(*o)).cast("long").alias(n) for n, o in orders.items()])
    got = with_tiles(df, "k", RANKINGS, buckets, bins).select("k", *orders)
    assert got.schema["up"].dataType == want.schema["up"].dataType
    return sorted(map(tuple, got.collect())), sorted(map(tuple, want.collect()))


def _rows(n, seed):
    rng = random.Random(seed)
    keys = rng.sample(range(-10 * n, 10 * n), n)
    amounts = [None, Decimal("0.01"), Decimal("-99999999999999999999999999999999999.99"), Decimal(10**35), Decimal("7.25")]
    return [
        (k, rng.choice([None, 0, 0, 0, rng.randrange(-5, 5), rng.randrange(-(2**62), 2**62)]),
         rng.choice([*amounts, Decimal(rng.randrange(10**6)).scaleb(-2)]), "x")
        for k in keys
    ]


@pytest.mark.parametrize("n, buckets, bins", [(0, 5, 8), (1, 5, 8), (3, 5, 1024), (11, 4, 64), (503, 5, 64), (1000, 7, 1024)])
def test_tiles_equal_ntile(spark, n, buckets, bins):
    got, want = _both(spark, _rows(n, n), buckets, bins)
    assert got == want


def test_one_value_and_all_null(spark):
    rows = [(k, 5, None, "") for k in range(0, 400, 3)]
    got, want = _both(spark, rows, 5, 32)
    assert got == want


def test_extreme_keys(spark):
    rows = [(k, 1, Decimal(1), None) for k in (-(2**63), -1, 0, 2**63 - 1, 17)]
    got, want = _both(spark, rows, 2, 64)
    assert got == want


def test_doubles_are_refused(spark):
    with pytest.raises(TypeError):
        with_tiles(spark.createDataFrame([(1, 0.5)], "k long, v double"), "k", [Ranking("v", "t")], 5)


def test_nothing_is_sorted_or_joined(spark):
    df = spark.createDataFrame(_rows(50, 1), SCHEMA)
    plan = with_tiles(df, "k", RANKINGS, 5)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Sort", "Window", "Join", "Exchange"))
