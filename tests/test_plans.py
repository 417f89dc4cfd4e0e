"""Physical-plan checks: built-in operators only, pushdown and pruning reach
the scans, no un-aggregated rows funnel into a single partition."""

from __future__ import annotations

import re

import pytest

from martlet.plans.catalog import CATALOG
from tests.conftest import SF_SMALL

# queries whose whole plan is checked (cheap to plan; they cover every layer)
CHECKED = ["fact_sales", "customer_report", "product_report", "kpi_summary", "product_yoy", "rfm",
           "dedup_latest", "cdc_merge", "cleaning_audit", "top5_products", "country_share"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", CHECKED)
def test_no_python_udfs(spark, name):
    plan = _plan(CATALOG[name](spark, SF_SMALL))
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_scan_prunes_columns(spark):
    plan = _plan(CATALOG["total_quantity"](spark, SF_SMALL))
    scans = [s for s in re.findall(r"ReadSchema: struct<[^>]*>", plan) if "l_" in s]
    assert scans and all("l_tax" not in s and "l_returnflag" not in s for s in scans)


def test_incremental_filter_reaches_scan(spark):
    from martlet.plans.warehouse import Warehouse
    from pyspark.sql import functions as F

    wh = Warehouse(spark, SF_SMALL)
    q = wh.table("orders").where(F.col("o_orderdate") > F.lit("1998-01-01").cast("timestamp_ntz"))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate" in _plan(q)


def test_dense_keys_avoid_single_partition_windows(spark):
    lines = _plan(CATALOG["dim_customers"](spark, SF_SMALL)).splitlines()
    singles = [i for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
    # the only single-partition exchange is the offsets window, and it sits on
    # the per-partition row counts (one row per range partition), never on
    # customer rows
    assert singles
    for i in singles:
        assert "HashAggregate(keys=[_part" in lines[i + 1]


def test_dedup_uses_partial_window_group_limit(spark):
    plan = _plan(CATALOG["dedup_latest"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan and "Partial" in plan
