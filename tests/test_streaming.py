"""Streaming daily counts: equal to the batch answer on real events; late
rows beyond the watermark are dropped; replayed events are counted once."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from martlet.streaming.daily_counts import run_daily_counts
from tests.conftest import SF_SMALL

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def test_stream_equals_batch_on_events(spark):
    got = run_daily_counts(spark, SF_SMALL)
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    expected = ev.groupBy(F.col("ts").cast("date").alias("day"), "event_type").agg(F.count("*").alias("events"))
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_late_rows_dropped_and_duplicates_counted_once(spark, tmp_path):
    T = dt.datetime
    batches = [
        [(1, T(2024, 1, 1, 10), 1, "click", 1.0, "{}"), (2, T(2024, 1, 1, 11), 1, "click", 1.0, "{}")],
        [(3, T(2024, 1, 3, 12), 1, "click", 1.0, "{}"), (2, T(2024, 1, 1, 11), 1, "click", 1.0, "{}")],
        # 2024-01-01 09:00 is far behind the watermark (max ts 2024-01-03 12:00 - 1 hour): dropped
        [(4, T(2024, 1, 1, 9), 1, "click", 1.0, "{}"), (5, T(2024, 1, 3, 11, 30), 1, "view", 1.0, "{}")],
    ]
    src = tmp_path / "events"
    src.mkdir()
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(src / f"b{i}"))
    # flatten into one folder of files, one file per micro-batch
    import glob
    import shutil

    flat = tmp_path / "flat"
    flat.mkdir()
    for i in range(len(batches)):
        f = glob.glob(str(src / f"b{i}" / "*.parquet"))[0]
        shutil.copy(f, flat / f"part-{i}.events.parquet")
    got = run_daily_counts(
        spark, str(flat), file_glob="*.events.parquet", schema=spark.createDataFrame([], SCHEMA).schema,
        max_files_per_trigger=1,
    )
    rows = sorted((r.day, r.event_type, r.events) for r in got.collect())
    assert rows == [(dt.date(2024, 1, 1), "click", 2), (dt.date(2024, 1, 3), "click", 1),
                    (dt.date(2024, 1, 3), "view", 1)]


def test_folder_table_gives_the_same_counts(spark, tmp_path):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    events.repartition(5).write.parquet(str(tmp_path / "events.parquet"))
    got, expected = run_daily_counts(spark, str(tmp_path)), run_daily_counts(spark, SF_SMALL)
    assert got.count() > 0 and got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_many_unordered_files_lose_no_row(spark, tmp_path):
    import os
    import shutil

    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    folder = tmp_path / "events.parquet"
    events.orderBy(F.desc("ts")).coalesce(1).write.option("maxRecordsPerFile", events.count() // 3).parquet(str(folder))
    events.where("false").coalesce(1).write.parquet(str(tmp_path / "none"))
    # the latest events first, and more than 1,000 files between one part file and the next
    for n, f in enumerate(sorted(folder.glob("part*"))):
        os.utime(f, (10_000_000 + n * 100_000,) * 2)
    for n in range(2_300):
        shutil.copy(next((tmp_path / "none").glob("part*")), folder / f"x{n}.parquet")
        os.utime(folder / f"x{n}.parquet", (10_000_001 + n % 2 * 100_000,) * 2)
    got = run_daily_counts(spark, str(tmp_path))
    expected = events.groupBy(F.col("ts").cast("date").alias("day"), "event_type").agg(F.count("*").alias("events"))
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_missing_input_is_an_error(spark, tmp_path):
    import pytest

    with pytest.raises(Exception):
        run_daily_counts(spark, str(tmp_path))


def test_session_settings_are_left_alone(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    run_daily_counts(spark, SF_SMALL, state_partitions=3)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
