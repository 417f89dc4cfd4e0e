"""Registry of named queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each entry builds a fresh ``Warehouse`` over the source folder, so every query
reads the whole source tables and is independent of the others.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from martlet.operators import gold, keys
from martlet.plans import advanced, cleaning, distincts, explore, incremental, insight, load, quality, report_states, rfm
from martlet.plans.warehouse import Warehouse
from martlet.session import work_path
from martlet.streaming import arrivals

QueryFn = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
        CATALOG[name] = lambda spark, sf_dir: fn(Warehouse(spark, sf_dir))
        return fn

    return deco


# ---- exploratory (gold star) ------------------------------------------------


@register("sales_by_category")
def _sales_by_category(wh: Warehouse) -> DataFrame:
    return explore.sales_by_category(wh.fact(customers=False, surrogate=False), wh.products_by_version)


# ---- layers and cleaning operators -----------------------------------------


def _layer(name: str, getter: Callable[[Warehouse], DataFrame]) -> None:
    register(name)(getter)


for _t in ("crm_cust_info", "crm_prd_info", "crm_sales_details", "erm_customers",
           "erm_customer_location", "erm_product_category"):
    _layer(f"silver_{_t}", lambda wh, _t=_t: wh.silver[_t])

_layer("dim_customers", lambda wh: wh.dim_customers)
_layer("dim_products", lambda wh: wh.dim_products)
_layer("fact_sales", lambda wh: wh.fact())


@register("dedup_latest")
def _dedup_latest(wh: Warehouse) -> DataFrame:
    return cleaning.latest_order_per_customer(wh.table("orders"))


@register("version_end_dates")
def _version_end_dates(wh: Warehouse) -> DataFrame:
    return cleaning.event_validity(wh.table("events"))


@register("dense_surrogate_key")
def _dense_surrogate_key(wh: Warehouse) -> DataFrame:
    return cleaning.numbered_orders(wh.table("orders"))


@register("decode_dates")
def _decode_dates(wh: Warehouse) -> DataFrame:
    return cleaning.decoded_dates(wh.bronze["crm_sales_details"])


@register("repair_sales")
def _repair_sales(wh: Warehouse) -> DataFrame:
    return cleaning.repaired_money(wh.bronze["crm_sales_details"])


@register("code_maps")
def _code_maps(wh: Warehouse) -> DataFrame:
    return cleaning.code_maps(wh.bronze["crm_cust_info"], wh.bronze["erm_customers"])


@register("key_normalise")
def _key_normalise(wh: Warehouse) -> DataFrame:
    return cleaning.key_normalise(wh.bronze["erm_customers"], wh.bronze["erm_customer_location"])


@register("country_standardise")
def _country_standardise(wh: Warehouse) -> DataFrame:
    return wh.silver["erm_customer_location"]


@register("gender_merge")
def _gender_merge(wh: Warehouse) -> DataFrame:
    return cleaning.gender_merge(wh.silver["crm_cust_info"], wh.silver["erm_customers"])



# ---- more exploratory queries -----------------------------------------------

# Thresholds scaled to the testdata's money amounts (every customer and product
# there sells far more than the source system's cut-offs); the functions'
# defaults keep the source values.
PRODUCT_SEGMENTS = {"high": 2_000_000, "mid": 1_400_000}
CUSTOMER_SEGMENTS = {"high": 3_000_000, "mid": 1_500_000}
COST_BANDS = {"high": 970, "low": 930}
CUSTOMER_TYPE = {"min_months": 12, "min_spend": 2_000_000}


def _dated_only(wh: Warehouse) -> DataFrame:
    return wh.fact(products=False, customers=False)


register("order_date_range")(lambda wh: explore.order_date_range(_dated_only(wh)))
register("total_sales")(lambda wh: explore.total_sales(_dated_only(wh)))
register("total_quantity")(lambda wh: explore.total_quantity(_dated_only(wh)))
register("avg_unit_price")(lambda wh: explore.avg_unit_price(_dated_only(wh)))
register("distinct_orders")(lambda wh: explore.distinct_orders(_dated_only(wh)))
register("distinct_customers")(
    lambda wh: explore.distinct_customers(wh.fact_by_customer_id(), customers=wh.customer_keys)
)
register("total_order_number")(
    lambda wh: explore.distinct_customers(
        wh.fact_by_customer_id(), name="total_order_number", customers=wh.customer_keys
    )
)
register("distinct_products")(lambda wh: explore.distinct_products(wh.fact(customers=False, surrogate=False)))
register("distinct_counts")(lambda wh: explore.distinct_counts(wh.sales_lines, wh.customer_keys, wh.product_ids))
register("kpi_summary")(lambda wh: explore.kpi_summary(wh.sales_lines, wh.customer_keys, wh.product_ids))
register("customers_by_country")(lambda wh: explore.customers_by_country(wh.customer_attributes))
register("customers_by_gender")(lambda wh: explore.customers_by_gender(wh.customer_attributes))
register("products_by_category")(lambda wh: explore.products_by_category(wh.active_products, key="_prd_id"))
register("avg_cost_by_category")(lambda wh: explore.avg_cost_by_category(wh.active_products))
register("revenue_per_customer")(
    lambda wh: explore.revenue_per_customer(wh.fact_by_customer_id(), wh.customer_attributes)
)
register("quantity_by_country")(
    lambda wh: explore.quantity_by_country(wh.fact_by_customer_id(), wh.customer_attributes)
)
register("top5_products")(
    lambda wh: explore.top_products(wh.fact(customers=False, surrogate=False), wh.products_by_version, 5)
)
register("bottom5_products")(
    lambda wh: explore.bottom_products(wh.fact(customers=False, surrogate=False), wh.products_by_version, 5)
)


# ---- advanced analysis and reports ------------------------------------------

register("monthly_trend")(lambda wh: advanced.monthly_trend(wh.fact_by_customer_id(), wh.customer_keys))
register("cumulative_sales")(lambda wh: advanced.cumulative_sales(_dated_only(wh)))
register("product_yoy")(
    lambda wh: advanced.product_yoy(wh.fact(customers=False, surrogate=False), wh.products_by_version)
)
register("cost_band")(lambda wh: advanced.cost_band(wh.active_products, **COST_BANDS))
register("customer_type")(
    lambda wh: advanced.customer_type(wh.fact_by_customer_id(), wh.dim_customers, **CUSTOMER_TYPE)
)
register("customer_type_fixed")(
    lambda wh: advanced.customer_type(
        wh.fact_by_customer_id(), wh.dim_customers, months_mode="total_months", **CUSTOMER_TYPE
    )
)
register("customer_type_counts")(
    lambda wh: advanced.customer_type_counts(wh.fact_by_customer_id(), wh.customer_keys, **CUSTOMER_TYPE)
)
register("customer_type_counts_fixed")(
    lambda wh: advanced.customer_type_counts(
        wh.fact_by_customer_id(), wh.customer_keys, months_mode="total_months", **CUSTOMER_TYPE
    )
)
register("product_report")(
    lambda wh: advanced.product_report(
        wh.sales_lines, wh.dim_products, wh.customer_keys, wh.as_of, **PRODUCT_SEGMENTS
    )
)
register("customer_report")(
    lambda wh: advanced.customer_report(
        wh.sales_lines, wh.dim_customers, wh.product_ids, wh.as_of, **CUSTOMER_SEGMENTS
    )
)



# ---- analyses reported without code ---------------------------------------

register("quarterly_trend")(lambda wh: insight.quarterly_trend(_dated_only(wh)))
register("line_revenue")(
    lambda wh: insight.line_revenue(wh.fact(customers=False, surrogate=False), wh.products_by_version)
)
register("country_share")(lambda wh: insight.country_share(wh.fact_by_customer_id(), wh.customer_attributes))
register("seasonality")(lambda wh: insight.seasonality(_dated_only(wh)))
register("age_gender")(
    lambda wh: insight.age_gender(wh.fact_by_customer_id(), wh.customer_attributes, wh.as_of)
)
register("top10_aov")(lambda wh: insight.top_products_aov(wh.fact(customers=False), wh.dim_products, 10))
register("gross_margin")(
    lambda wh: insight.gross_margin(wh.fact(customers=False, surrogate=False), wh.products_by_version)
)
register("yoy_growth")(lambda wh: insight.yoy_growth(_dated_only(wh)))
register("revenue_per_customer_country")(
    lambda wh: insight.revenue_per_customer_country(wh.fact_by_customer_id(), wh.customer_attributes)
)


@register("discontinued_share")
def _discontinued_share(wh: Warehouse) -> DataFrame:
    dim = wh.current_products_with_source_end.withColumnRenamed("_prd_id", "product_key")
    return insight.discontinued_share(gold.fact_sales(wh.silver["crm_sales_details"], dim), dim)


register("version_flags")(lambda wh: insight.version_flags(wh.silver_products_with_source_end))
register("whitespace_strip")(lambda wh: insight.strip_text_columns(wh.bronze["crm_cust_info"]))
register("headline_kpis")(lambda wh: explore.headline_kpis(wh.sales_lines, wh.customer_keys, wh.product_ids))


def _audit(wh: Warehouse) -> DataFrame:
    return quality.cleaning_audit(wh, wh.customer_attributes)


register("cleaning_audit")(_audit)
register("dq_checks")(lambda wh: quality.dq_checks(_audit(wh)))


@register("row_count_variance")
def _row_count_variance(wh: Warehouse) -> DataFrame:
    """The second delivery lacks every fifth customer and every 50th location."""
    first = {n: wh.bronze[n] for n in ("crm_cust_info", "crm_prd_info", "erm_customers", "erm_customer_location")}
    second = dict(first)
    second["crm_cust_info"] = first["crm_cust_info"].where("cst_id is null or cst_id % 5 <> 0")
    second["erm_customer_location"] = first["erm_customer_location"].where("cast(substr(cid, 4) as bigint) % 50 <> 0")
    return quality.variance_of_second_load(first, second, threshold=0.05)


@register("stable_customer_keys")
def _stable_customer_keys(wh: Warehouse) -> DataFrame:
    """A first load knows the customers created before 1996, a second one all
    customers but every seventh."""
    root = work_path(wh.spark, "customer-keys")
    customers = wh.silver["crm_cust_info"].select("cst_id", "cst_create_date")
    keys.register(customers.where("cst_create_date < date'1996-01-01'"), "cst_id", root, "customer_id")
    return keys.registered(customers.where("cst_id % 7 <> 0"), "cst_id", root, "customer_id")


# ---- next steps: incremental, CDC, streaming, RFM ---------------------------

INITIAL_LOAD_BEFORE = dt.date(2000, 1, 1)

register("rfm")(lambda wh: rfm.rfm_scores(wh.fact_by_customer_id(), wh.as_of, wh.customer_keys))
register("incremental_load")(
    lambda wh: incremental.incremental_load(
        wh.spark, wh.silver["crm_sales_details"], "sls_order_dt", INITIAL_LOAD_BEFORE
    )
)
register("cdc_merge")(
    lambda wh: incremental.cdc_merge(
        wh.silver["crm_cust_info"], incremental.customer_change_feed(wh.table("orders"))
    )
)
# three micro-batches, each of a third of the events by time
register("stream_daily_counts")(lambda wh: arrivals.counts_in_ranges(wh.spark, wh.table("events"), ranges=3))


# the second load brings the later and undated lines, and the year 1998 once more
register("distinct_states")(
    lambda wh: distincts.counts_over_loads(
        wh.silver["crm_sales_details"],
        ["sls_order_dt < date'1999-01-01'", "sls_order_dt is null or sls_order_dt >= date'1998-01-01'"],
    )
)


#: Lines up to 1998, later and undated ones, and the second load once more.
REPORT_LOADS = [
    ("until-1998", "order_date < date'1999-01-01'"),
    ("from-1999", "order_date is null or order_date >= date'1999-01-01'"),
    ("from-1999", "order_date is null or order_date >= date'1999-01-01'"),
]


@register("product_report_refreshed")
def _product_report_refreshed(wh: Warehouse) -> DataFrame:
    root = report_states.stored_loads(wh.sales_lines, REPORT_LOADS, report_states.PRODUCT)
    metrics = report_states.metrics(wh.spark, root, report_states.PRODUCT, wh.customer_keys)
    return advanced.product_report_of(metrics, wh.dim_products, wh.as_of, **PRODUCT_SEGMENTS)


@register("customer_report_refreshed")
def _customer_report_refreshed(wh: Warehouse) -> DataFrame:
    root = report_states.stored_loads(wh.sales_lines, REPORT_LOADS, report_states.CUSTOMER)
    metrics = report_states.metrics(wh.spark, root, report_states.CUSTOMER, wh.product_ids)
    return advanced.customer_report_of(metrics, wh.dim_customers, wh.as_of, **CUSTOMER_SEGMENTS)


register("csv_roundtrip")(lambda wh: load.csv_roundtrip(wh))
register("csv_rejects")(lambda wh: load.csv_rejects(wh))
register("load_warehouse")(lambda wh: load.loaded_contents(wh, PRODUCT_SEGMENTS, CUSTOMER_SEGMENTS))


FLAGSHIP = "customer_report"
