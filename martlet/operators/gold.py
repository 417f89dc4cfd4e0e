"""Gold layer: customer and product dimensions with dense surrogate keys, and
the sales fact.

Joins are plain equi-joins: Catalyst broadcasts a side whose estimated size is
under ``spark.sql.autoBroadcastJoinThreshold`` and AQE converts a shuffle join
to a broadcast one when the *measured* size of a side is under
``spark.sql.adaptive.autoBroadcastJoinThreshold``; beyond that they stay
sort-merge joins (with AQE splitting skewed partitions).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.functions import codes
from martlet.operators.windows import global_row_number, latest_per_key

DIM_CUSTOMER_COLUMNS = [
    "customer_id",
    "customer_key",
    "first_name",
    "last_name",
    "birth_date",
    "gender",
    "marital_status",
    "country",
    "create_date",
]
DIM_PRODUCT_COLUMNS = [
    "product_key",
    "product_id",
    "product_name",
    "category_id",
    "category",
    "subcategory",
    "maintenance",
    "cost",
    "product_line",
    "start_date",
    "end_date",
]
FACT_COLUMNS = [
    "order_number",
    "product_key",
    "customer_key",
    "order_date",
    "shipping_date",
    "due_date",
    "sales_amount",
    "quantity",
    "unit_price",
]


def customer_attributes(cust: DataFrame, erp: DataFrame, loc: DataFrame) -> DataFrame:
    """CRM customers left-joined to ERP demographics and locations on the
    normalised customer key, with the gender priority merge and the country
    fallback applied. No surrogate key yet."""
    ci = cust.alias("ci")
    ec = erp.alias("ec")
    el = loc.alias("el")
    joined = ci.join(ec, F.col("ci.cst_key") == F.col("ec.cid"), "left").join(
        el, F.col("ci.cst_key") == F.col("el.cid"), "left"
    )
    return joined.select(
        F.col("ci.cst_id").alias("customer_key"),
        F.col("ci.cst_firstname").alias("first_name"),
        F.col("ci.cst_lastname").alias("last_name"),
        F.col("ec.birth_date").alias("birth_date"),
        codes.gender_priority(F.col("ci.cst_gndr"), F.col("ec.gender")).alias("gender"),
        F.col("ci.cst_marital_status").alias("marital_status"),
        codes.country_fallback(F.col("el.country")).alias("country"),
        F.col("ci.cst_create_date").alias("create_date"),
    )


def dim_customers(cust: DataFrame, erp: DataFrame, loc: DataFrame) -> DataFrame:
    """``customer_id`` = dense surrogate 1..n in ``cst_id`` order; ``customer_key``
    = natural key."""
    attrs = customer_attributes(cust, erp, loc)
    numbered = global_row_number(
        attrs,
        [F.asc("customer_key"), F.asc("birth_date"), F.asc("gender"), F.asc("country")],
        "customer_id",
    )
    return numbered.select(*DIM_CUSTOMER_COLUMNS)


def active_products(prd: DataFrame, cat: DataFrame) -> DataFrame:
    """Current product versions (no end date) left-joined to their category."""
    pi = prd.where(F.col("prd_end_dt").isNull()).alias("pi")
    return _with_category(pi, cat, "src_prd_end_dt" in prd.columns)


def _with_category(pi: DataFrame, cat: DataFrame, has_source_end: bool) -> DataFrame:
    pi = pi.alias("pi")
    pc = cat.alias("pc")
    joined = pi.join(pc, F.col("pi.cat_id") == F.col("pc.id"), "left")
    cols = [
        F.col("pi.prd_id").alias("_prd_id"),
        F.col("pi.prd_key").alias("product_id"),
        F.col("pi.prd_nm").alias("product_name"),
        F.col("pi.cat_id").alias("category_id"),
        F.col("pc.category").alias("category"),
        F.col("pc.subcategory").alias("subcategory"),
        F.col("pc.maintenance").alias("maintenance"),
        F.col("pi.prd_cost").alias("cost"),
        F.col("pi.prd_line").alias("product_line"),
        F.col("pi.prd_start_dt").alias("start_date"),
        F.col("pi.prd_end_dt").alias("end_date"),
    ]
    if has_source_end:
        cols.append(F.col("pi.src_prd_end_dt").alias("src_end_date"))
    return joined.select(*cols)


def current_versions(silver_prd_without_end: DataFrame, cat: DataFrame) -> DataFrame:
    """The rows whose rebuilt end date is NULL, without computing the end dates.

    ``LEAD(start) OVER (PARTITION BY raw key ORDER BY start NULLS LAST, id)``
    is NULL exactly for the last version with a start date and for versions
    without one, so the current versions are the keep-latest row among dated
    versions plus all undated ones: one keep-latest shuffle (skew-safe through
    its partial window-group limit) instead of the full version history.
    ``silver_prd_without_end`` is the silver product table before the end-date
    step, still carrying the raw key as ``_raw_key``.
    """
    dated = latest_per_key(
        silver_prd_without_end.where(F.col("prd_start_dt").isNotNull()),
        "_raw_key",
        [F.desc("prd_start_dt"), F.desc("prd_id")],
    )
    undated = silver_prd_without_end.where(F.col("prd_start_dt").isNull())
    current = dated.unionByName(undated).withColumn("prd_end_dt", F.lit(None).cast("date")).drop("_raw_key")
    return _with_category(current, cat, "src_prd_end_dt" in current.columns)


def dim_products(prd: DataFrame, cat: DataFrame, active: DataFrame | None = None) -> DataFrame:
    """``product_key`` = dense surrogate 1..n in ``prd_id`` order; ``product_id``
    = natural key. Only active versions (pass ``active`` if already selected,
    e.g. by ``current_versions``)."""
    if active is None:
        active = active_products(prd, cat)
    numbered = global_row_number(active, [F.asc("_prd_id")], "product_key")
    extra = ["src_end_date"] if "src_end_date" in active.columns else []
    return numbered.select(*DIM_PRODUCT_COLUMNS, *extra)


def fact_sales(
    sales: DataFrame,
    products: DataFrame | None = None,
    customers: DataFrame | None = None,
    raw_customer_key: bool = False,
    raw_product_id: bool = False,
) -> DataFrame:
    """Sales lines with the product surrogate key and the customer natural key.

    Both dimension joins are left joins, so the fact has exactly one row per
    sales line (the dimensions are unique on their join keys). A dimension
    passed as ``None`` is not joined and its key column is absent -- callers
    that never read a key skip that join entirely. ``raw_customer_key`` exposes
    the sales line's customer id as ``customer_key`` without the join (orphan
    ids are *not* nulled): for callers that aggregate per customer and then
    inner-join the customer dimension, which drops orphans anyway;
    ``raw_product_id`` exposes the line's product key as ``product_id`` likewise.
    """
    sd = sales.alias("sd")
    out = sd
    cols = [F.col("sd.sls_ord_num").alias("order_number")]
    if products is not None:
        dp = products.select("product_key", "product_id").alias("dp")
        out = out.join(dp, F.col("sd.sls_prd_key") == F.col("dp.product_id"), "left")
        cols.append(F.col("dp.product_key"))
    elif raw_product_id:
        cols.append(F.col("sd.sls_prd_key").alias("product_id"))
    if customers is not None:
        dc = customers.select("customer_key").alias("dc")
        out = out.join(dc, F.col("sd.sls_cust_id") == F.col("dc.customer_key"), "left")
        cols.append(F.col("dc.customer_key"))
    elif raw_customer_key:
        cols.append(F.col("sd.sls_cust_id").alias("customer_key"))
    cols += [
        F.col("sd.sls_order_dt").alias("order_date"),
        F.col("sd.sls_ship_dt").alias("shipping_date"),
        F.col("sd.sls_due_dt").alias("due_date"),
        F.col("sd.sls_sales").alias("sales_amount"),
        F.col("sd.sls_quantity").alias("quantity"),
        F.col("sd.sls_price").alias("unit_price"),
    ]
    return out.select(*cols)
