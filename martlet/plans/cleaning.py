"""Cleaning and integration operators applied to source tables directly, and
column-level views of what each silver rule did (raw value next to result).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.functions import codes, dates, money
from martlet.operators.windows import global_row_number, latest_per_key, lead_within_key


def latest_order_per_customer(orders: DataFrame) -> DataFrame:
    """Keep-latest dedup on a table with real duplicates: each customer's most
    recent order (NULL dates first, same-day ties to the higher order key)."""
    latest = latest_per_key(
        orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus"),
        "o_custkey",
        [F.desc_nulls_first("o_orderdate"), F.desc("o_orderkey")],
    )
    return latest.select(
        "o_custkey",
        "o_orderkey",
        F.col("o_orderdate").cast("date").alias("last_order_date"),
        "o_totalprice",
        "o_orderstatus",
    )


def event_validity(events: DataFrame) -> DataFrame:
    """Version end dates on an event history: each event of a user is valid from
    its day until the day before the user's next event (open-ended if last)."""
    ev = events.select("event_id", "user_id", "ts", "event_type")
    with_next = lead_within_key(
        ev, keys=["user_id"], order=[F.asc_nulls_last("ts"), F.asc("event_id")], value="ts", out="_next_ts"
    )
    return with_next.select(
        "event_id",
        "user_id",
        "event_type",
        F.col("ts").cast("date").alias("valid_from"),
        F.date_sub(F.col("_next_ts").cast("date"), 1).alias("valid_to"),
    )


def numbered_orders(orders: DataFrame) -> DataFrame:
    """Dense 1..n surrogate key over a large table in order-key order."""
    return global_row_number(orders.select("o_orderkey", "o_custkey"), [F.asc("o_orderkey")], "order_id")


def decoded_dates(bronze_sales: DataFrame) -> DataFrame:
    return bronze_sales.select(
        "sls_ord_num",
        "sls_prd_key",
        F.col("sls_order_dt").alias("raw_order_dt"),
        F.col("sls_ship_dt").alias("raw_ship_dt"),
        F.col("sls_due_dt").alias("raw_due_dt"),
        dates.decode_yyyymmdd_guarded("sls_order_dt").alias("order_date"),
        dates.decode_yyyymmdd("sls_ship_dt").alias("ship_date"),
        dates.decode_yyyymmdd("sls_due_dt").alias("due_date"),
    )


def repaired_money(bronze_sales: DataFrame) -> DataFrame:
    return bronze_sales.select(
        "sls_ord_num",
        "sls_prd_key",
        F.col("sls_sales").cast("double").alias("raw_sales"),
        "sls_quantity",
        F.col("sls_price").cast("double").alias("raw_price"),
        money.repaired_sales("sls_sales", "sls_quantity", "sls_price").cast("double").alias("sales"),
        money.repaired_price("sls_sales", "sls_quantity", "sls_price").cast("double").alias("price"),
    )


def code_maps(bronze_cust: DataFrame, bronze_erp: DataFrame) -> DataFrame:
    """Strict CRM codes next to the tolerant ERP gender, by customer key."""
    crm = bronze_cust.select(
        "cst_key",
        F.col("cst_marital_status").alias("raw_marital"),
        codes.marital_status("cst_marital_status").alias("marital_status"),
        F.col("cst_gndr").alias("raw_crm_gender"),
        codes.crm_gender("cst_gndr").alias("crm_gender"),
    )
    erp = bronze_erp.select(
        codes.strip_customer_prefix("cid").alias("cst_key"),
        F.col("gender").alias("raw_erp_gender"),
        codes.erp_gender("gender").alias("erp_gender"),
    )
    return crm.join(erp, "cst_key", "left")


def key_normalise(bronze_erp: DataFrame, bronze_loc: DataFrame) -> DataFrame:
    """ERP customer ids before/after prefix and dash removal."""
    a = bronze_erp.select(
        F.lit("erm_customers").alias("source"),
        F.col("cid").alias("raw_cid"),
        codes.strip_customer_prefix("cid").alias("cid"),
    )
    b = bronze_loc.select(
        F.lit("erm_customer_location").alias("source"),
        F.col("cid").alias("raw_cid"),
        codes.remove_dashes("cid").alias("cid"),
    )
    return a.unionByName(b)


def gender_merge(silver_cust: DataFrame, silver_erp: DataFrame) -> DataFrame:
    """Per customer: CRM gender, ERP gender and the merged value (CRM first)."""
    crm = silver_cust.select(F.col("cst_id").alias("customer_key"), "cst_key", F.col("cst_gndr").alias("crm_gender"))
    erp = silver_erp.select(F.col("cid").alias("cst_key"), F.col("gender").alias("erp_gender"))
    return crm.join(erp, "cst_key", "left").select(
        "customer_key",
        "crm_gender",
        "erp_gender",
        codes.gender_priority("crm_gender", "erp_gender").alias("gender"),
    )
