"""Reports from stored states of several loads equal reports of all lines."""

from __future__ import annotations

import datetime as dt
import decimal
import random

import pytest

from martlet.plans import advanced, report_states
from martlet.session import work_path
from martlet.sources import versions

SCHEMA = (
    "product_id string, customer_key long, order_number string, order_date date, sales_amount decimal(18,2), "
    "quantity int, extra string"
)


def _lines(seed: int, n: int = 300):
    rng = random.Random(seed)
    day = dt.date(2000, 1, 1)
    return [
        (
            rng.choice(["hot", "hot", "a", "b", f"p{rng.randrange(30)}", None]),
            rng.choice([1, rng.randrange(40), None]),
            rng.choice([f"SO{rng.randrange(60)}", None]),
            rng.choice([day + dt.timedelta(rng.randrange(900))] * 9 + [None]),
            rng.choice([decimal.Decimal(rng.randrange(-500, 10**6)) / 100, None]),
            rng.choice([rng.randrange(9), None]),
            "x",
        )
        for _ in range(n)
    ]


def _rebuilt(lines, report, members):
    m = advanced._per_key_metrics(lines, report.key, report.partner, members, report.counted)
    return _sorted(m, report)


def _sorted(m, report):
    columns = [report.key, "_sales", "total_quantity", "_first", "_last", "total_orders", report.counted]
    return sorted((tuple(r) for r in m.select(*columns).collect()), key=str)


@pytest.fixture(scope="module")
def members(spark):
    return {
        "product": spark.createDataFrame([(i,) for i in range(0, 40, 2)], "customer_key long"),
        "customer": spark.createDataFrame([("hot",), ("a",), ("p3",), ("p4",)], "product_id string"),
    }


@pytest.mark.parametrize("report", [report_states.PRODUCT, report_states.CUSTOMER], ids=lambda r: r.name)
def test_refresh_equals_rebuild(spark, members, report):
    root = work_path(spark, "test-states")
    known = members[report.name]
    loads = {"one": _lines(1), "two": _lines(2), "none": [], "three": _lines(3) + _lines(1)[:50]}
    so_far = []
    for name, rows in loads.items():
        so_far += rows
        lines = spark.createDataFrame(rows, SCHEMA)
        assert report_states.add_load(lines, root, name, report)
        want = _rebuilt(spark.createDataFrame(so_far, SCHEMA), report, known)
        assert _sorted(report_states.metrics(spark, root, report, known), report) == want
    # a load that comes twice, before and after the slices are merged
    before = versions.newest_version(spark, root)
    assert not report_states.add_load(spark.createDataFrame(loads["two"], SCHEMA), root, "two", report)
    assert versions.newest_version(spark, root) == before
    report_states.compact(spark, root, report)
    assert not report_states.add_load(spark.createDataFrame(loads["two"], SCHEMA), root, "two", report)
    assert report_states.taken(spark, root) == set(loads)
    assert _sorted(report_states.metrics(spark, root, report, known), report) == want
    # old slices may go, and later loads go on from the merged ones
    assert versions.vacuum(spark, root) > 0
    last = _lines(4)
    report_states.add_load(spark.createDataFrame(last, SCHEMA), root, "four", report)
    want = _rebuilt(spark.createDataFrame(so_far + last, SCHEMA), report, known)
    assert _sorted(report_states.metrics(spark, root, report, known), report) == want


def test_old_lines_are_not_read_and_old_slices_stay(spark, tmp_path):
    root, old = work_path(spark, "test-states"), str(tmp_path / "old")
    report = report_states.PRODUCT
    spark.createDataFrame(_lines(5), SCHEMA).write.parquet(old)
    lines = spark.read.parquet(old)
    report_states.add_load(lines, root, "old", report)
    _, first = versions.manifest(spark, root)
    members = lines.select("customer_key").distinct()
    everyone = members.collect()
    rows = lines.collect()
    for file in (tmp_path / "old").iterdir():  # whoever reads the old lines fails
        file.write_bytes(b"")
    more = _lines(6)
    report_states.add_load(spark.createDataFrame(more, SCHEMA), root, "new", report)
    _, second = versions.manifest(spark, root)
    assert first.items() < second.items()
    members = spark.createDataFrame([r for r in everyone if r[0] is not None], "customer_key long")
    want = _rebuilt(spark.createDataFrame(rows + [tuple(r) for r in more], SCHEMA), report, members)
    assert _sorted(report_states.metrics(spark, root, report, members), report) == want


def test_members_that_arrive_later_are_counted(spark):
    root, report = work_path(spark, "test-states"), report_states.PRODUCT
    day = dt.date(2001, 5, 5)
    lines = spark.createDataFrame([("a", 7, "SO1", day, decimal.Decimal("1.00"), 1, "x")], SCHEMA)
    report_states.add_load(lines, root, "one", report)
    ids = spark.createDataFrame([(7,)], "customer_key long")
    assert [r.total_customers for r in report_states.metrics(spark, root, report, ids.where("false")).collect()] == [0]
    assert [r.total_customers for r in report_states.metrics(spark, root, report, ids).collect()] == [1]


def test_a_load_killed_before_its_commit_changes_nothing(spark, monkeypatch):
    root, report = work_path(spark, "test-states"), report_states.CUSTOMER
    ids = spark.createDataFrame([("hot",), ("a",)], "product_id string")
    first, second = (spark.createDataFrame(_lines(s, 80), SCHEMA) for s in (7, 8))
    report_states.add_load(first, root, "one", report)
    want = _sorted(report_states.metrics(spark, root, report, ids), report)
    with monkeypatch.context() as m:
        m.setattr(versions.Load, "commit", lambda self: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            report_states.add_load(second, root, "two", report)
    assert _sorted(report_states.metrics(spark, root, report, ids), report) == want
    assert report_states.add_load(second, root, "two", report)
    want = _rebuilt(first.unionByName(second), report, ids)
    assert _sorted(report_states.metrics(spark, root, report, ids), report) == want


def test_no_loads(spark):
    root, report = work_path(spark, "test-states"), report_states.PRODUCT
    ids = spark.createDataFrame([], "customer_key long")
    assert report_states.metrics(spark, root, report, ids).count() == 0
