"""The skew-safe window operators equal their plain-window definitions,
including when one key holds a third of all rows."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from martlet.operators.windows import global_row_number, latest_per_key, lead_within_key, ntile_from_row_number
from tests.conftest import SF_CHECK


def _skewed(spark, n=3000):
    # key 0 holds a third of all rows; other keys have 1-3 rows
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997 + 1).alias("k"),
        ((F.col("id") * 7919) % 1000).alias("o"),
        F.col("id").alias("uid"),
    )


def _plain_lead(df):
    w = W.partitionBy("k").orderBy("o", "uid")
    return df.withColumn("nxt", F.lead("o").over(w))


def test_lead_within_key_matches_window_on_hot_key(spark):
    df = _skewed(spark)
    got = lead_within_key(df, ["k"], [F.asc("o"), F.asc("uid")], "o", "nxt", num_partitions=7)
    expected = _plain_lead(df)
    assert got.count() == df.count()
    assert got.select("uid", "nxt").exceptAll(expected.select("uid", "nxt")).count() == 0
    # the hot key really was split over several chunks
    spread = df.repartitionByRange(7, "k", "o", "uid").where("k = 0").select(F.spark_partition_id()).distinct()
    assert spread.count() > 1


def test_lead_within_key_on_events(spark):
    ev = spark.read.parquet(f"{SF_CHECK}/events.parquet").select("event_id", "user_id", "ts")
    got = lead_within_key(ev, ["user_id"], [F.asc("ts"), F.asc("event_id")], "ts", "nxt", num_partitions=5)
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    expected = ev.withColumn("nxt", F.lead("ts").over(w))
    assert got.select("event_id", "nxt").exceptAll(expected.select("event_id", "nxt")).count() == 0


def test_global_row_number_is_dense_and_ordered(spark):
    orders = spark.read.parquet(f"{SF_CHECK}/orders.parquet").select("o_orderkey", "o_orderdate")
    got = global_row_number(orders, [F.asc("o_orderdate"), F.asc("o_orderkey")], "rn", num_partitions=6, total="n")
    expected = orders.withColumn("rn", F.row_number().over(W.orderBy("o_orderdate", "o_orderkey")).cast("long"))
    assert got.select("o_orderkey", "rn").exceptAll(expected.select("o_orderkey", "rn")).count() == 0
    stats = got.agg(F.min("rn"), F.max("rn"), F.countDistinct("rn"), F.max("n")).first()
    n = orders.count()
    assert tuple(stats) == (1, n, n, n)


def test_ntile_formula_matches_ntile(spark):
    for n in [1, 4, 5, 6, 13, 101]:
        df = spark.range(n).select(F.col("id").alias("v"))
        expected = df.withColumn("t", F.ntile(5).over(W.orderBy("v")).cast("long"))
        got = df.withColumn("rn", F.col("v") + 1).withColumn(
            "t", ntile_from_row_number(F.col("rn"), F.lit(n), 5)
        )
        assert got.select("v", "t").exceptAll(expected.select("v", "t")).count() == 0, n


def test_latest_per_key_null_dates_win_and_null_keys_drop(spark):
    import datetime as dt

    rows = [(1, dt.date(2013, 7, 1), "a"), (1, None, "b"), (2, dt.date(2012, 1, 1), "c"),
            (2, dt.date(2013, 1, 1), "d"), (None, dt.date(2014, 1, 1), "e")]
    df = spark.createDataFrame(rows, "k int, d date, v string")
    got = latest_per_key(df, "k", [F.desc_nulls_first("d"), F.desc("v")])
    assert sorted((r.k, r.v) for r in got.collect()) == [(1, "b"), (2, "d")]


def test_latest_per_key_hot_key_plans_partial_limit(spark):
    df = _skewed(spark)
    got = latest_per_key(df, "k", [F.desc("o"), F.desc("uid")])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert got.count() == df.select("k").distinct().count()


def test_lead_within_key_with_null_keys_over_several_chunks(spark):
    rows = [(None if i % 3 else i % 2, i) for i in range(2000)]
    df = spark.createDataFrame(rows, "k int, o int")
    got = lead_within_key(df, ["k"], [F.asc("o")], "o", "nxt", num_partitions=4)
    expected = df.withColumn("nxt", F.lead("o").over(W.partitionBy("k").orderBy("o")))
    assert got.columns == ["k", "o", "nxt"]
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0
