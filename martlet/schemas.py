"""Declared schemas of the bronze and silver layers.

Schemas are fixed and positional: sources are read with these types, never
inferred. Integer business keys are widened from INT to BIGINT because the key
space of the testdata tables (``c_custkey``, ``p_partkey``) exceeds 2^31 at
large scale factors; nothing else about the types changes.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
COST = T.DecimalType(10, 2)

BRONZE = {
    "crm_cust_info": T.StructType(
        [
            T.StructField("cst_id", T.LongType()),
            T.StructField("cst_key", T.StringType()),
            T.StructField("cst_firstname", T.StringType()),
            T.StructField("cst_lastname", T.StringType()),
            T.StructField("cst_marital_status", T.StringType()),
            T.StructField("cst_gndr", T.StringType()),
            T.StructField("cst_create_date", T.DateType()),
        ]
    ),
    "crm_prd_info": T.StructType(
        [
            T.StructField("prd_id", T.LongType()),
            T.StructField("prd_key", T.StringType()),
            T.StructField("prd_nm", T.StringType()),
            T.StructField("prd_cost", COST),
            T.StructField("prd_line", T.StringType()),
            T.StructField("prd_start_dt", T.DateType()),
            T.StructField("prd_end_dt", T.DateType()),
        ]
    ),
    "crm_sales_details": T.StructType(
        [
            T.StructField("sls_ord_num", T.StringType()),
            T.StructField("sls_prd_key", T.StringType()),
            T.StructField("sls_cust_id", T.LongType()),
            T.StructField("sls_order_dt", T.StringType()),
            T.StructField("sls_ship_dt", T.StringType()),
            T.StructField("sls_due_dt", T.StringType()),
            T.StructField("sls_sales", MONEY),
            T.StructField("sls_quantity", T.IntegerType()),
            T.StructField("sls_price", MONEY),
        ]
    ),
    "erm_customers": T.StructType(
        [
            T.StructField("cid", T.StringType()),
            T.StructField("birth_date", T.DateType()),
            T.StructField("gender", T.StringType()),
        ]
    ),
    "erm_customer_location": T.StructType(
        [
            T.StructField("cid", T.StringType()),
            T.StructField("country", T.StringType()),
        ]
    ),
    "erm_product_category": T.StructType(
        [
            T.StructField("id", T.StringType()),
            T.StructField("category", T.StringType()),
            T.StructField("subcategory", T.StringType()),
            T.StructField("maintenance", T.StringType()),
        ]
    ),
}


def _silver(fields: list[T.StructField]) -> T.StructType:
    return T.StructType(fields)


SILVER = {
    "crm_cust_info": BRONZE["crm_cust_info"],
    "crm_prd_info": _silver(
        [
            T.StructField("prd_id", T.LongType()),
            T.StructField("cat_id", T.StringType()),
            T.StructField("prd_key", T.StringType()),
            T.StructField("prd_nm", T.StringType()),
            T.StructField("prd_cost", COST),
            T.StructField("prd_line", T.StringType()),
            T.StructField("prd_start_dt", T.DateType()),
            T.StructField("prd_end_dt", T.DateType()),
        ]
    ),
    "crm_sales_details": _silver(
        [
            T.StructField("sls_ord_num", T.StringType()),
            T.StructField("sls_prd_key", T.StringType()),
            T.StructField("sls_cust_id", T.LongType()),
            T.StructField("sls_order_dt", T.DateType()),
            T.StructField("sls_ship_dt", T.DateType()),
            T.StructField("sls_due_dt", T.DateType()),
            T.StructField("sls_sales", MONEY),
            T.StructField("sls_quantity", T.IntegerType()),
            T.StructField("sls_price", MONEY),
        ]
    ),
    "erm_customers": BRONZE["erm_customers"],
    "erm_customer_location": BRONZE["erm_customer_location"],
    "erm_product_category": BRONZE["erm_product_category"],
}

AUDIT_COLUMN = "dwh_create_date"
