"""Silver layer: one pure cleaning function per bronze table.

Each function maps a bronze DataFrame to its silver form. Only two of them
shuffle: the latest-row dedup of customers (partial window-group limit before
the exchange) and the version end dates of products (range-partitioned lead).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.functions import codes, dates, money
from martlet.operators.windows import latest_per_key, lead_within_key
from martlet.schemas import SILVER
from martlet.sources.sinks import conform


def clean_cust_info(bronze: DataFrame) -> DataFrame:
    """Latest row per ``cst_id`` (NULL ids dropped, NULL create dates win as in
    a DESC sort with NULLs first, remaining ties broken by the other columns),
    names trimmed, marital status and gender decoded strictly."""
    latest = latest_per_key(
        bronze,
        "cst_id",
        [
            F.desc_nulls_first("cst_create_date"),
            F.desc_nulls_first("cst_key"),
            F.desc_nulls_first("cst_firstname"),
            F.desc_nulls_first("cst_lastname"),
            F.desc_nulls_first("cst_marital_status"),
            F.desc_nulls_first("cst_gndr"),
        ],
    )
    out = latest.select(
        "cst_id",
        "cst_key",
        F.trim("cst_firstname").alias("cst_firstname"),
        F.trim("cst_lastname").alias("cst_lastname"),
        codes.marital_status("cst_marital_status").alias("cst_marital_status"),
        codes.crm_gender("cst_gndr").alias("cst_gndr"),
        "cst_create_date",
    )
    return conform(out, SILVER["crm_cust_info"])


def clean_prd_info(bronze: DataFrame, keep_source_end: bool = False) -> DataFrame:
    """Category id and product key split out of the raw key, NULL cost -> 0,
    product line decoded, and the end date rebuilt as the day before the next
    version's start (the source end date is discarded; ``keep_source_end``
    keeps it as ``src_prd_end_dt`` for discontinuation analysis).

    The lead is partitioned by the *raw* key, before it is overwritten.
    """
    with_next = lead_within_key(
        bronze,
        keys=["prd_key"],
        order=[F.asc_nulls_last("prd_start_dt"), F.asc("prd_id")],
        value="prd_start_dt",
        out="_next_start",
    )
    out = with_next.select(
        "prd_id",
        codes.category_id("prd_key").alias("cat_id"),
        codes.product_key("prd_key").alias("prd_key"),
        "prd_nm",
        F.coalesce("prd_cost", F.lit(0)).alias("prd_cost"),
        codes.product_line("prd_line").alias("prd_line"),
        "prd_start_dt",
        F.date_sub("_next_start", 1).alias("prd_end_dt"),
        F.col("prd_end_dt").alias("src_prd_end_dt"),
    )
    fields = list(SILVER["crm_prd_info"].fields)
    if keep_source_end:
        fields.append(T.StructField("src_prd_end_dt", T.DateType()))
    return conform(out, T.StructType(fields))


def clean_prd_info_without_end(bronze: DataFrame, keep_source_end: bool = False) -> DataFrame:
    """Silver product columns except the rebuilt end date, plus the raw key as
    ``_raw_key`` (what the end date is partitioned by)."""
    cols = [
        "prd_id",
        codes.category_id("prd_key").alias("cat_id"),
        codes.product_key("prd_key").alias("prd_key"),
        "prd_nm",
        F.coalesce("prd_cost", F.lit(0)).cast(SILVER["crm_prd_info"]["prd_cost"].dataType).alias("prd_cost"),
        codes.product_line("prd_line").alias("prd_line"),
        "prd_start_dt",
        F.col("prd_key").alias("_raw_key"),
    ]
    if keep_source_end:
        cols.append(F.col("prd_end_dt").alias("src_prd_end_dt"))
    return bronze.select(*cols)


def clean_sales_details(bronze: DataFrame) -> DataFrame:
    """Date codes decoded (order date guarded), sales and price repaired."""
    out = bronze.select(
        "sls_ord_num",
        "sls_prd_key",
        "sls_cust_id",
        dates.decode_yyyymmdd_guarded("sls_order_dt").alias("sls_order_dt"),
        dates.decode_yyyymmdd("sls_ship_dt").alias("sls_ship_dt"),
        dates.decode_yyyymmdd("sls_due_dt").alias("sls_due_dt"),
        money.repaired_sales("sls_sales", "sls_quantity", "sls_price").alias("sls_sales"),
        "sls_quantity",
        money.repaired_price("sls_sales", "sls_quantity", "sls_price").alias("sls_price"),
    )
    return conform(out, SILVER["crm_sales_details"])


def clean_erp_customers(bronze: DataFrame, as_of: dt.date) -> DataFrame:
    """``NAS`` prefix dropped, birth dates after ``as_of`` nulled, gender decoded
    tolerantly. ``as_of`` replaces the source system's CURRENT_DATE."""
    out = bronze.select(
        codes.strip_customer_prefix("cid").alias("cid"),
        F.when(F.col("birth_date") > F.lit(as_of), F.lit(None)).otherwise(F.col("birth_date")).alias("birth_date"),
        codes.erp_gender("gender").alias("gender"),
    )
    return conform(out, SILVER["erm_customers"])


def clean_customer_location(bronze: DataFrame) -> DataFrame:
    out = bronze.select(
        codes.remove_dashes("cid").alias("cid"),
        codes.standardise_country("country").alias("country"),
    )
    return conform(out, SILVER["erm_customer_location"])


def clean_product_category(bronze: DataFrame) -> DataFrame:
    """Pass-through load."""
    return conform(bronze, SILVER["erm_product_category"])


def silver_tables(bronze, as_of: dt.date, keep_source_end: bool = False):
    """The six silver tables, each built lazily from its bronze table."""
    from martlet.sources.testdata import LazyTables

    return LazyTables(
        {
            "crm_cust_info": lambda: clean_cust_info(bronze["crm_cust_info"]),
            "crm_prd_info": lambda: clean_prd_info(bronze["crm_prd_info"], keep_source_end=keep_source_end),
            "crm_sales_details": lambda: clean_sales_details(bronze["crm_sales_details"]),
            "erm_customers": lambda: clean_erp_customers(bronze["erm_customers"], as_of),
            "erm_customer_location": lambda: clean_customer_location(bronze["erm_customer_location"]),
            "erm_product_category": lambda: clean_product_category(bronze["erm_product_category"]),
        }
    )
