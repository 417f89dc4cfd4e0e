"""Event lots: counts and side rows together are all events, whatever arrives when."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from martlet.session import work_path
from martlet.streaming import arrivals as A
from tests.conftest import SF_SMALL

SCHEMA = "event_id long, ts timestamp, event_type string"
HOUR = dt.timedelta(hours=1)


def T(day, hour=0, minute=0):
    return dt.datetime(2024, 1, day, hour, minute)


def lots_of(spark, batches):
    root = work_path(spark, "lots")
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).repartition(2).write.parquet(f"{root}/{n}")
    return [f"{root}/{n}" for n in range(len(batches))]


def counted(df):
    return {(r.day, r.event_type): r.events for r in df.collect()}


def batch_counts(rows):
    out, seen = {}, set()
    for i, ts, kind in sorted(rows, key=lambda r: (r[1] is None, r[1] or T(1))):
        if i not in seen:
            seen.add(i)
            key = (None if ts is None else ts.date(), kind)
            out[key] = out.get(key, 0) + 1
    return out


def test_shuffled_folder_in_ranges(spark, tmp_path):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    events.repartition(9).write.parquet(str(tmp_path / "events.parquet"))
    shuffled = spark.read.parquet(str(tmp_path / "events.parquet"))
    root = work_path(spark, "arrivals")
    lots = A.land_in_ranges(shuffled, f"{root}/lots", ranges=4, tasks=2)
    assert len(lots) == 4
    edges = [spark.read.parquet(lot).agg(F.min("ts"), F.max("ts"), F.count("*")).first() for lot in lots]
    assert all(a[1] <= b[0] for a, b in zip(edges, edges[1:])) and sum(e[2] for e in edges) == events.count()
    got = A.count_arrivals(spark, lots, f"{root}/run")
    assert got.batches == 4 and all(x.aside == 0 for x in got.lots) and got.aside.count() == 0
    want = events.groupBy(F.col("ts").cast("date").alias("day"), "event_type").agg(F.count("*").alias("events"))
    assert got.counts.exceptAll(want).count() == 0 and want.exceptAll(got.counts).count() == 0


def test_files_in_any_order_lose_nothing(spark, tmp_path):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type"
    )
    order = [3, 0, 4, 1, 2, 5]
    parts = events.withColumn("part", F.ntile(6).over(Window.orderBy("ts")))
    lots, largest, late = [], None, set()
    for n in order:
        mine = parts.where(F.col("part") == n + 1).drop("part")
        mine.write.parquet(f"{tmp_path}/{n}")
        lots.append(f"{tmp_path}/{n}")
        rows = [tuple(r) for r in mine.collect()]
        if largest is not None:
            late |= {r for r in rows if r[1] <= largest.replace(microsecond=largest.microsecond // 1000 * 1000) - HOUR}
        largest = max([largest or dt.datetime.min, *[r[1] for r in rows]])
    got = A.count_arrivals(spark, lots, delay=HOUR)
    assert got.batches == sum(x.landed > 0 for x in got.lots) >= 3 and late
    assert {tuple(r) for r in got.aside.collect()} == late
    assert sum(counted(got.counts).values()) + got.aside.count() == events.count()
    assert counted(A.settled_counts(got)) == batch_counts([tuple(r) for r in events.collect()])


BATCHES = [
    [(1, T(1, 10), "click"), (2, T(1, 11), "click"), (2, T(1, 11), "click"), (8, None, "view")],
    [(3, T(3, 12), "click"), (2, T(1, 11), "click")],  # a replay within the watermark of the lot before
    [(4, T(1, 9), "click"), (5, T(3, 11, 30), "view"), (1, T(1, 10), "click")],  # late, in time, late replay
    [(6, T(3, 11), "view"), (7, T(3, 11, 0), "view"), (None, T(3, 13), "view")],  # at the watermark: late
]


def test_late_undated_and_replayed_rows(spark):
    got = A.count_arrivals(spark, lots_of(spark, BATCHES), delay=HOUR)
    assert [(x.landed, x.aside) for x in got.lots] == [(3, 1), (2, 0), (1, 2), (1, 2)]
    day = lambda d: dt.date(2024, 1, d)
    assert counted(got.counts) == {(day(1), "click"): 2, (day(3), "click"): 1, (day(3), "view"): 2}
    assert sorted((r.event_id for r in got.aside.collect())) == [1, 4, 6, 7, 8]
    settled = {(day(1), "click"): 3, (day(3), "click"): 1, (day(3), "view"): 4, (None, "view"): 1}
    assert counted(A.settled_counts(got)) == settled == batch_counts([r for b in BATCHES for r in b])


def test_a_stopped_run_goes_on(spark, monkeypatch):
    whole = A.count_arrivals(spark, lots_of(spark, BATCHES), delay=HOUR)
    lots, root = lots_of(spark, BATCHES), work_path(spark, "arrivals")
    A.count_arrivals(spark, lots[:2], root, HOUR)
    seen = []
    real = A.Lot

    def killed(name, *rest):
        seen.append(name)
        raise OSError("killed after a lot landed")

    monkeypatch.setattr(A, "Lot", killed)
    with pytest.raises(OSError):
        A.count_arrivals(spark, lots, root, HOUR)
    monkeypatch.setattr(A, "Lot", real)
    got = A.count_arrivals(spark, lots, root, HOUR)
    assert seen == ["lot-000002"] and [x.name for x in got.lots] == ["lot-000003"]
    assert counted(got.counts) == counted(whole.counts)
    assert sorted(map(str, got.aside.collect())) == sorted(map(str, whole.aside.collect()))


def test_state_is_bounded_by_the_watermark(spark):
    # 40 days of 50 events: ids of closed days leave the state
    rows = [(1000 * d + i, T(1) + dt.timedelta(days=d, minutes=i), "click") for d in range(40) for i in range(50)]
    root = work_path(spark, "arrivals")
    lots = A.land_in_ranges(spark.createDataFrame(rows, SCHEMA), f"{root}/lots", ranges=8)
    sizes = []
    real = A.write_batches

    def watched(*args):
        writer = real(*args)

        class Started:
            def start(self):
                self.query = writer.start()
                sizes.append(self.query)
                return self.query

        return Started()

    A.write_batches = watched
    try:
        got = A.count_arrivals(spark, lots, f"{root}/run", state_partitions=2)
    finally:
        A.write_batches = real
    state = [sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in sizes[0].recentProgress]
    assert got.batches == 8 and max(state) <= 3 * len(rows) / 8 + 20 < len(rows)


def test_empty_lots_and_tables(spark):
    got = A.count_arrivals(spark, lots_of(spark, [[], BATCHES[0], []]), delay=HOUR)
    assert sum(counted(got.counts).values()) == 2
    none = A.count_arrivals(spark, [])
    assert none.counts.count() == 0 and A.settled_counts(none).count() == 0
    assert A.counts_in_ranges(spark, spark.createDataFrame([], SCHEMA), ranges=3).count() == 0
    assert os.path.exists(work_path(spark, "x")) is False
