"""Incremental loads read changed slices only; change merges rewrite touched buckets only."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from martlet.plans import incremental
from martlet.session import build_session, release_staged, work_path
from martlet.sources import versions

D = dt.date
ROWS = [(1, D(2020, 1, 1)), (2, D(2020, 1, 2)), (3, None), (3, None), (4, D(2020, 1, 3)), (5, D(2020, 1, 3))]


def table(spark, rows):
    return spark.createDataFrame(rows, "id long, at date")


def same_rows(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def files_of(spark, target):
    """Files and their times of every committed slice."""
    out = {}
    for name, s in versions.manifest(spark, target)[1].items():
        folder = s.path.removeprefix("file:")
        out[name] = {f: os.stat(f"{folder}/{f}").st_mtime_ns for f in os.listdir(folder)}
    return out


def test_every_row_once_with_undated_and_late_rows(spark):
    source = table(spark, ROWS)
    assert same_rows(incremental.incremental_load(spark, source, "at", D(2020, 1, 2)), source)


def test_only_changed_slices_are_loaded(spark):
    target = work_path(spark, "t")
    load = lambda rows: incremental.load_changed_slices(spark, target, table(spark, rows), "at", "MONTH")
    rows = [*ROWS, (6, D(2020, 2, 9)), (7, D(2020, 12, 31)), (8, D(2021, 1, 1))]
    got, loaded = load(rows)
    assert same_rows(got, table(spark, rows))
    assert loaded == ["2020-01-01", "2020-02-01", "2020-12-01", "2021-01-01", "undated"]
    before, version = files_of(spark, target), versions.manifest(spark, target)[0]
    assert load(rows[::-1])[1] == [] and versions.manifest(spark, target)[0] == version
    # a late row, a corrected row, an undated row and a new month
    later = [(1, D(2020, 1, 5)), *rows[1:], (5, D(2020, 1, 3)), (9, None), (9, D(2021, 3, 1))]
    got, loaded = load(later)
    assert same_rows(got, table(spark, later)) and loaded == ["2020-01-01", "2021-03-01", "undated"]
    after = files_of(spark, target)
    assert {n for n in before if after[n] == before[n]} == {"2020-02-01", "2020-12-01", "2021-01-01"}
    # a slice that the source dropped stays, as in any append-only target
    got, loaded = load([r for r in later if r[1] != D(2020, 2, 9)])
    assert loaded == [] and same_rows(got, table(spark, later))


def test_a_failed_load_leaves_the_target(spark):
    target = work_path(spark, "t")
    got, _ = incremental.load_changed_slices(spark, target, table(spark, ROWS), "at")
    broken = table(spark, [*ROWS, (9, D(2022, 1, 1))])
    before = versions.commit
    try:
        versions.commit = lambda *a: (_ for _ in ()).throw(OSError("killed before the commit"))
        with pytest.raises(OSError):
            incremental.load_changed_slices(spark, target, broken, "at")
    finally:
        versions.commit = before
    _, slices = versions.manifest(spark, target)
    assert same_rows(versions.read_slices(spark, list(slices.values()), broken.schema), table(spark, ROWS))
    again, loaded = incremental.load_changed_slices(spark, target, broken, "at")
    assert loaded == ["2022-01-01"] and same_rows(again, broken)
    # the folder of the failed run goes, what is committed stays
    assert versions.vacuum(spark, target) >= 1
    assert same_rows(incremental.load_changed_slices(spark, target, broken, "at")[0], broken)


def test_a_version_is_committed_once(spark):
    target = work_path(spark, "t")
    incremental.load_changed_slices(spark, target, table(spark, ROWS), "at")
    with pytest.raises(RuntimeError):
        versions.commit(spark, target, 0, [])


def test_changed_slices_are_date_ranges_at_the_scan(spark):
    path = work_path(spark, "t")
    table(spark, ROWS).write.parquet(path)
    wanted = incremental.in_slices(F.col("at"), ["2020-01-01", "2020-04-01"], "QUARTER")
    plan = spark.read.parquet(path).where(wanted)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(at,2020-01-01)" in plan and "LessThan(at,2020-07-01)" in plan
    with pytest.raises(ValueError):
        incremental.slice_of(F.col("at"), "DAY")


def test_empty_source(spark):
    target = work_path(spark, "t")
    got, loaded = incremental.load_changed_slices(spark, target, table(spark, []), "at")
    assert got.count() == 0 and loaded == [] and got.columns == ["id", "at"]
    assert incremental.load_changed_slices(spark, target, table(spark, ROWS), "at")[0].count() == len(ROWS)


BASE = "cst_id long, cst_key string, cst_firstname string, cst_lastname string, cst_marital_status string, cst_gndr string, cst_create_date date"
FEED = "cst_id long, cst_key string, cst_marital_status string, change_date date, change_seq long, op string"


def test_merge_keeps_columns_and_is_idempotent(spark):
    base = spark.createDataFrame(
        [(1, "AW1", "A", "a", "Single", "Male", D(2020, 1, 1)), (2, "AW2", "B", "b", "Single", "n/a", D(2020, 1, 1)),
         (3, "AW3", "C", "c", "Single", "n/a", D(2022, 1, 1)), (4, "AW4", "D", "d", "Single", "n/a", None)], BASE)
    feed = spark.createDataFrame(
        [(1, "AW1", "Married", D(2021, 1, 1), 5, "U"), (1, "AW1", "Single", D(2020, 6, 1), 9, "U"),
         (2, "AW2", "Married", D(2021, 1, 1), 1, "U"), (2, "AW2", "Married", D(2021, 1, 1), 2, "D"),
         (3, "AW3", "Married", D(2021, 1, 1), 1, "D"), (9, "AW9", "Married", D(2021, 1, 1), 1, "U")], FEED)
    target = work_path(spark, "customers")
    want = [
        (1, "AW1", "A", "a", "Married", "Male", D(2020, 1, 1), D(2021, 1, 1), "change"),
        (3, "AW3", "C", "c", "Single", "n/a", D(2022, 1, 1), D(2022, 1, 1), "base"),
        (4, "AW4", "D", "d", "Single", "n/a", None, None, "base"),
        (9, "AW9", None, None, "Married", None, None, D(2021, 1, 1), "change"),
    ]
    for _ in range(2):
        got = incremental.cdc_merge(base, feed, target)
        assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == want
    assert versions.manifest(spark, target)[0] == 1
    gone = spark.createDataFrame([(1, "AW1", "Married", D(2023, 1, 1), 1, "D")], FEED)
    assert {r.cst_id for r in incremental.cdc_merge(base, gone, target).collect()} == {3, 4, 9}


def test_merge_rewrites_only_touched_buckets(spark):
    base = spark.createDataFrame([(i, f"AW{i}", "A", "a", "Single", "Male", D(2020, 1, 1)) for i in range(200)], BASE)
    target = work_path(spark, "customers")
    none = spark.createDataFrame([], FEED)
    assert incremental.cdc_merge(base, none, target, buckets=8).count() == 200
    before = files_of(spark, target)
    assert set(before) == {str(b) for b in range(8)}
    feed = spark.createDataFrame(
        [(3, "AW3", "Married", D(2021, 1, 1), 1, "U"), (900, "AW900", "Single", D(2021, 1, 1), 1, "U"),
         (5, "AW5", "Single", D(2019, 1, 1), 1, "U")], FEED)
    got = incremental.cdc_merge(base, feed, target, buckets=8)
    rows = {r.cst_id: r for r in got.collect()}
    assert len(rows) == 201 and rows[3].cst_marital_status == "Married" and rows[5].source == "base"
    keys = spark.createDataFrame([(3,), (900,)], "k long").select(incremental.bucket_of(F.col("k"), 8)).collect()
    changed = {r[0] for r in keys}
    after = files_of(spark, target)
    # the bucket that only an outdated change falls into keeps its files too
    assert {n for n in after if after[n] != before[n]} == changed
    version = versions.manifest(spark, target)[0]
    assert incremental.cdc_merge(base, feed, target, buckets=8).exceptAll(got).count() == 0
    assert versions.manifest(spark, target)[0] == version and files_of(spark, target) == after
    every = spark.createDataFrame([(i, f"AW{i}", "x", D(2022, 1, 1), 1, "D") for i in [*range(200), 900]], FEED)
    assert incremental.cdc_merge(base, every, target, buckets=8).count() == 0


def test_staged_folders_are_released(spark):
    own = spark.newSession()
    path = work_path(own, "t")
    own.range(3).write.parquet(path)
    assert os.path.isdir(path.removeprefix("file:"))
    assert release_staged(own) == 1 and not os.path.exists(path.removeprefix("file:"))
    assert build_session is not None
