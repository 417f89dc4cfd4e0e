"""Properties of the warehouse built from the smallest testdata folder."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from martlet.plans import advanced
from martlet.plans.warehouse import Warehouse
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def wh(spark):
    return Warehouse(spark, SF_SMALL)


def test_silver_customers_unique(wh):
    s = wh.silver["crm_cust_info"]
    assert s.count() == s.select("cst_id").distinct().count()


def test_version_intervals_do_not_overlap(wh):
    p = wh.silver["crm_prd_info"]
    w = W.partitionBy("cat_id", "prd_key").orderBy("prd_start_dt", "prd_id")
    nxt = p.withColumn("_next", F.lead("prd_start_dt").over(w))
    bad = nxt.where(F.col("prd_end_dt").isNotNull() & (F.col("prd_end_dt") >= F.col("_next")))
    assert bad.count() == 0
    # exactly one open version per product key
    open_versions = p.where(F.col("prd_end_dt").isNull()).groupBy("cat_id", "prd_key").count()
    assert open_versions.where("count != 1").count() == 0


def test_surrogate_keys_are_1_to_n(wh):
    for dim, key in [(wh.dim_customers, "customer_id"), (wh.dim_products, "product_key")]:
        n = dim.count()
        got = dim.agg(F.min(key), F.max(key), F.countDistinct(key)).first()
        assert tuple(got) == (1, n, n)


def test_fact_has_one_row_per_sales_line(wh):
    assert wh.fact().count() == wh.silver["crm_sales_details"].count() == wh.bronze["crm_sales_details"].count()


def test_segments_sum_to_total(wh):
    rep = advanced.customer_report(
        wh.sales_lines, wh.dim_customers, wh.product_ids, wh.as_of, high=3_000_000, mid=1_500_000
    )
    seg = rep.groupBy("spending_segment").agg(F.sum("total_sales").alias("s"))
    known = F.col("order_date").isNotNull() & F.col("customer_key").isNotNull()
    total = wh.fact().where(known).agg(F.sum("sales_amount")).first()[0]
    assert abs(sum(r.s for r in seg.collect()) - float(total)) < 1e-3


def test_rerun_gives_same_result(spark):
    a = Warehouse(spark, SF_SMALL).dim_products.select("product_key", "product_id")
    b = Warehouse(spark, SF_SMALL).dim_products.select("product_key", "product_id")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_customer_type_reference_mode_never_vip(wh):
    typed = advanced.customer_type(wh.fact(products=False), wh.dim_customers, min_months=12, min_spend=0)
    assert typed.where(F.col("customer_type") == "VIP Customer").count() == 0
    fixed = advanced.customer_type(
        wh.fact(products=False), wh.dim_customers, min_months=12, min_spend=0, months_mode="total_months"
    )
    assert fixed.where(F.col("customer_type") == "VIP Customer").count() > 0


def test_sinks_overwrite_is_idempotent(spark, tmp_path):
    from martlet.sources.sinks import overwrite_path

    df = spark.range(10)
    overwrite_path(df, str(tmp_path / "t"))
    overwrite_path(df, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 10


def test_raw_customer_id_fact_drops_orphans_like_the_join(wh, spark):
    """Aggregating on the raw sales customer id and inner-joining the customer
    dimension equals the reference form (fact left-joined to customers first),
    also when a sales line refers to a customer that does not exist."""
    from martlet.operators import gold
    from martlet.plans import explore, rfm

    sales = wh.silver["crm_sales_details"]
    orphan = sales.limit(3).withColumn("sls_cust_id", F.lit(-42).cast("long"))
    sales = sales.unionByName(orphan)
    joined = gold.fact_sales(sales, None, wh.customer_keys)
    raw = gold.fact_sales(sales, None, None, raw_customer_key=True)
    assert raw.where("customer_key = -42").count() == 3
    assert joined.where("customer_key IS NULL").count() == raw.where("customer_key < 0").count()

    a = explore.revenue_per_customer(joined, wh.customer_attributes)
    b = explore.revenue_per_customer(raw, wh.customer_attributes)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0

    r1 = rfm.customer_rfm_base(joined, wh.as_of)
    r2 = rfm.customer_rfm_base(raw, wh.as_of, wh.customer_keys)
    assert r1.exceptAll(r2).count() == 0 and r2.exceptAll(r1).count() == 0

    m1 = advanced.monthly_trend(joined)
    m2 = advanced.monthly_trend(raw, wh.customer_keys)
    assert m1.exceptAll(m2).count() == 0 and m2.exceptAll(m1).count() == 0

    d1 = explore.distinct_customers(joined).first()[0]
    d2 = explore.distinct_customers(raw, customers=wh.customer_keys).first()[0]
    assert d1 == d2


def test_reports_count_only_known_partners(spark, wh):
    """The pre-aggregated reports equal the plain form over the joined fact."""
    fact = wh.fact().where("order_date is not null")
    plain = fact.where("customer_key is not null").groupBy("customer_key").agg(
        F.countDistinct("product_key").alias("total_products"), F.countDistinct("order_number").alias("total_orders")
    )
    got = advanced.customer_report(wh.sales_lines, wh.dim_customers, wh.product_ids, wh.as_of)
    got = got.select("customer_key", "total_products", "total_orders")
    assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0
    plain = fact.where("product_key is not null").groupBy("product_key").agg(F.countDistinct("customer_key").alias("n"))
    got = advanced.product_report(wh.sales_lines, wh.dim_products, wh.customer_keys, wh.as_of)
    got = got.select("product_key", F.col("total_customers").alias("n"))
    assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0


def test_binding_reaches_every_cleaning_rule(wh):
    cust = wh.bronze["crm_cust_info"]
    assert cust.where("cst_id is null").count() > 0
    assert cust.where("cst_id is not null").count() > wh.silver["crm_cust_info"].count()
    assert wh.dim_products.where("category is null").count() > 0
    assert wh.customer_attributes.where("country = 'unknown'").count() > 0
    fact = wh.fact()
    assert fact.where("customer_key is null").count() > 0 and fact.where("product_key is null").count() > 0


def test_gold_is_built_from_the_written_silver(spark, wh):
    from martlet.plans import catalog, load

    created = load.load_warehouse(wh, catalog.PRODUCT_SEGMENTS, catalog.CUSTOMER_SEGMENTS)
    assert created["gold.fact_sales"] == "view" and created["gold.rpt_customer_report"] == "table"
    plan = spark.table("gold.fact_sales")._jdf.queryExecution().optimizedPlan().toString()
    assert "l_extendedprice" not in plan and "o_orderkey" not in plan
    assert any("silver.crm_sales_details" in f for f in spark.table("gold.fact_sales").inputFiles())
    loaded = load.LoadedWarehouse(spark, wh.as_of)
    for df in (loaded.sales_lines, loaded.customer_attributes, loaded.active_products):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "p_partkey" not in plan and "c_custkey" not in plan and "l_orderkey" not in plan
    fact = spark.table("gold.fact_sales")
    assert fact.exceptAll(wh.fact()).count() == 0 and fact.count() == wh.fact().count()
    for layer, name in (k.split(".") for k, kind in created.items() if kind == "table" and not k.startswith("bronze")):
        assert spark.table(f"{layer}.{name}").where("dwh_create_date is null").count() == 0


def test_line_price_is_worked_out_once(spark):
    from martlet.sources import testdata

    lines = spark.createDataFrame(
        [(1, 1, 1, 3.0, 10.0, dt.datetime(2000, 1, 2))],
        "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_shipdate timestamp",
    )
    orders = spark.createDataFrame([(1, 7, dt.datetime(2000, 1, 1))], "o_orderkey long, o_custkey long, o_orderdate timestamp")
    part = spark.createDataFrame([(1, "a b", "STEEL", "Brand#1")], "p_partkey long, p_name string, p_type string, p_brand string")
    sales = testdata.bronze_crm_sales_details(lines, orders, part)
    plan = sales._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"cast\(l_extendedprice", plan)) == 1
    assert [str(v) for v in sales.first()] == [
        "SO1", "A-B-ST-01", "7", "20000101", "20000102", "20000131", "9.99", "3", "3.33"
    ]
