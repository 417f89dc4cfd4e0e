"""Merged bitmaps count as distinct counts over all rows do."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from martlet.operators import bitmaps
from martlet.plans import distincts

SCHEMA = "g string, a long, b int"


def _rows(n, seed):
    rng = random.Random(seed)
    ids = [None, 0, -1, 1, 32768, 32769, -32768, -32769, 2**40]
    return [(rng.choice(["x", "y", None]), rng.choice([*ids, rng.randrange(-(10**5), 10**5)]), rng.randrange(50)) for _ in range(n)]


def test_merged_states_count_distinct_ids(spark):
    loads = [_rows(400, 1), _rows(400, 2), _rows(400, 2)]  # one comes twice
    parts = None
    for rows in loads:
        part = bitmaps.states(spark.createDataFrame(rows, SCHEMA), ["g"], ["a", "b"])
        parts = part if parts is None else parts.unionByName(part)
    every = spark.createDataFrame([r for rows in loads for r in rows], SCHEMA)
    exact = [F.countDistinct(c).alias(c) for c in ("a", "b")]
    got = bitmaps.counts(parts, [F.col("g")], ["a", "b"]).collect()
    assert sorted(got, key=str) == sorted(every.groupBy("g").agg(*exact).collect(), key=str)
    coarse = bitmaps.merged(parts, [F.lit(1).alias("one")])
    got = bitmaps.counts(coarse, [F.col("one")], ["a", "b"]).select("a", "b").collect()
    assert got == every.agg(*exact).collect()


def test_nulls_and_empty_tables(spark):
    rows = spark.createDataFrame([("x", None, 1), ("y", None, None)], SCHEMA)
    assert [tuple(r) for r in bitmaps.counts(bitmaps.states(rows, ["g"], ["a", "b"]), [F.col("g")], ["a", "b"]).collect()] == [
        ("x", 0, 1)
    ]
    assert bitmaps.states(rows.where("false"), ["g"], ["a"]).count() == 0


def test_orders_of_a_day_share_few_bitmaps(spark, tmp_path):
    # 70,000 order numbers, their days by turns: three buckets of ids, twenty days
    lines = spark.range(140_000).select(
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 70_000 % 20).cast("int")).alias("sls_order_dt"),
        F.col("id").alias("sls_cust_id"),
        F.format_string("SO%06d", F.col("id") % 70_000).alias("sls_ord_num"),
        F.when(F.col("id") % 3 > 0, F.lit("p")).alias("sls_prd_key"),
    )
    for _ in range(2):  # the second load brings nothing new
        distincts.add_load(lines, str(tmp_path))
    states = distincts.stored_states(spark, str(tmp_path))
    assert states.where("counted = 'orders'").count() <= 2 * (20 + 2)
    got = distincts.period_counts(states).collect()
    assert sorted(map(tuple, got)) == [("2020-01", 140_000, 70_000, 1), ("all", 140_000, 70_000, 1)]
