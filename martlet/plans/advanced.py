"""Advanced analysis: trends, running totals, year-over-year per product,
segmentation, and the product / customer report views.

Thresholds are parameters; their defaults are the source system's values.
Fact rows are aggregated to the dimension key before joining the dimension,
and windows only ever run over already-aggregated rows (years, product-years).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from martlet.functions.dates import age_month_part, age_months
from martlet.plans.explore import money


def _year(c: str) -> Column:
    return F.year(c).cast("long")


def monthly_trend(fact: DataFrame, customers: DataFrame | None = None) -> DataFrame:
    """Sales, distinct customers and quantity per order year and month.

    With ``customers`` (valid customer keys) the fact may carry raw sales
    customer ids: it is first aggregated to (month, customer id) -- map-side
    partial aggregation, one row per pair crosses the shuffle -- and only those
    pairs are matched against the customer keys; unmatched ids still add their
    sales and quantity but are not counted as customers, as in the reference
    (fact left-joined to customers first)."""
    month = [_year("order_date").alias("order_year"), F.month("order_date").cast("long").alias("order_month")]
    dated = fact.where(F.col("order_date").isNotNull())
    if customers is None:
        per_month = dated.groupBy(*month).agg(
            money(F.sum("sales_amount")).alias("total_sales"),
            F.countDistinct("customer_key").alias("total_customers"),
            F.sum("quantity").cast("long").alias("total_quantity"),
        )
    else:
        pairs = dated.groupBy(*month, "customer_key").agg(
            F.sum("sales_amount").alias("_s"), F.sum("quantity").alias("_q")
        )
        keys = customers.select(F.col("customer_key").alias("_valid"))
        matched = pairs.join(keys, pairs.customer_key == keys._valid, "left")
        per_month = matched.groupBy("order_year", "order_month").agg(
            money(F.sum("_s")).alias("total_sales"),
            F.countDistinct("_valid").alias("total_customers"),
            F.sum("_q").cast("long").alias("total_quantity"),
        )
    return per_month.orderBy(F.asc_nulls_last("order_year"), F.asc_nulls_last("order_month"))


def yearly_sales(fact: DataFrame) -> DataFrame:
    """Exact decimal revenue per order year (dated orders only)."""
    return (
        fact.where(F.col("order_date").isNotNull())
        .groupBy(_year("order_date").alias("order_year"))
        .agg(F.sum("sales_amount").alias("_total"))
    )


def cumulative_sales(fact: DataFrame) -> DataFrame:
    """Yearly revenue and its running total. The window is un-partitioned but
    runs after the yearly aggregate, so it sees one row per year."""
    running = W.orderBy("order_year").rangeBetween(W.unboundedPreceding, W.currentRow)
    return (
        yearly_sales(fact)
        .select(
            "order_year",
            money("_total").alias("total_sales"),
            money(F.sum("_total").over(running)).alias("cumulative_sales"),
        )
        .orderBy("order_year")
    )


def product_yoy(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Per product name and order year: revenue against the product's average
    year (rounded to cents) and against the previous year that had sales.
    Undated sales form a NULL year, which sorts after all real years."""
    per_key = fact.where(F.col("product_key").isNotNull()).groupBy(
        _year("order_date").alias("order_year"), "product_key"
    ).agg(F.sum("sales_amount").alias("_rev"))
    yearly = (
        per_key.join(products.select("product_key", "product_name"), "product_key")
        .groupBy("order_year", "product_name")
        .agg(F.sum("_rev").alias("_rev"))
    )
    by_name = W.partitionBy("product_name")
    by_year = W.partitionBy("product_name").orderBy(F.asc_nulls_last("order_year"))
    # computed once and reused by the difference and the status
    staged = yearly.withColumn("_avg", F.round(F.avg("_rev").over(by_name), 2)).withColumn(
        "_prev", F.lag("_rev").over(by_year)
    )
    rev, avg, prev = F.col("_rev"), F.col("_avg"), F.col("_prev")
    return staged.select(
        "order_year",
        "product_name",
        money(rev).alias("total_revenue"),
        money(avg).alias("avg_revenue"),
        money(rev - avg).alias("revenue_difference"),
        F.when(rev > avg, "Above Average").when(rev < avg, "Below Average").otherwise("Average").alias("revenue_status"),
        money(prev).alias("prev_year_revenue"),
        F.when(rev > prev, "Increase").when(rev < prev, "Decrease").otherwise("Stable").alias("revenue_trend"),
    ).orderBy("product_name", F.asc_nulls_last("order_year"))


def cost_band(products: DataFrame, high: float = 500, low: float = 100) -> DataFrame:
    cost = F.col("cost")
    return products.select(
        "product_name",
        money(cost).alias("cost"),
        F.when(cost > high, "High").when(cost < low, "Low").otherwise("Medium").alias("cost_category"),
    )


def _customer_spending(fact: DataFrame, customers: DataFrame, months_mode: str) -> DataFrame:
    per_key = (
        fact.where(F.col("order_date").isNotNull() & F.col("customer_key").isNotNull())
        .groupBy("customer_key")
        .agg(
            F.sum("sales_amount").alias("_spend"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
        )
    )
    span = age_month_part if months_mode == "reference" else age_months
    return per_key.join(customers.select("customer_key", "customer_id"), "customer_key").select(
        "customer_id",
        "_spend",
        "first_order_date",
        "last_order_date",
        span("last_order_date", "first_order_date").alias("total_months"),
    )


def _customer_type(months: Column, spend: Column, min_months: int, min_spend: float) -> Column:
    return (
        F.when((months >= min_months) & (spend >= min_spend), "VIP Customer")
        .when((months < min_months) & (spend < min_spend), "Regular Customer")
        .otherwise("New Customer")
    )


def customer_type(
    fact: DataFrame,
    customers: DataFrame,
    min_months: int = 12,
    min_spend: float = 3000,
    months_mode: str = "reference",
) -> DataFrame:
    """Customer spending and type. ``months_mode="reference"`` measures the span
    with the *month field* of the age (0-11), as the source does, so the VIP
    branch can never fire; ``"total_months"`` uses complete months."""
    spend = _customer_spending(fact, customers, months_mode)
    return spend.select(
        "customer_id",
        money("_spend").alias("total_spending"),
        "first_order_date",
        "last_order_date",
        "total_months",
        _customer_type(F.col("total_months"), F.col("_spend"), min_months, min_spend).alias("customer_type"),
    ).orderBy(F.desc_nulls_first("total_months"))


def customer_type_counts(
    fact: DataFrame,
    customers: DataFrame,
    min_months: int = 12,
    min_spend: float = 3000,
    months_mode: str = "reference",
) -> DataFrame:
    """How many customers are of each type; ``customers`` need only their
    natural keys, since the surrogate is not part of the answer."""
    keys = customers.select("customer_key", F.col("customer_key").alias("customer_id"))
    spend = _customer_spending(fact, keys, months_mode)
    typed = spend.select(
        _customer_type(F.col("total_months"), F.col("_spend"), min_months, min_spend).alias("customer_type")
    )
    return (
        typed.groupBy("customer_type")
        .agg(F.count(F.lit(1)).alias("total_customers"))
        .orderBy(F.desc_nulls_first("total_customers"))
    )


def _per_key_metrics(lines: DataFrame, key: str, other: str, members: DataFrame, counted: str) -> DataFrame:
    """Order and sales metrics per ``key`` over dated lines, and ``counted``
    distinct ids of ``other`` that ``members`` knows. Sums, orders and partner
    ids are aggregated apart, each with a partial aggregate before its shuffle,
    and joined per key; no line is expanded or shuffled for a dimension."""
    dated = lines.where(F.col("order_date").isNotNull() & F.col(key).isNotNull())
    sums = dated.groupBy(key).agg(
        F.sum("sales_amount").alias("_sales"),
        F.sum("quantity").cast("long").alias("total_quantity"),
        F.max("order_date").alias("_last"),
        F.min("order_date").alias("_first"),
        F.countDistinct("order_number").alias("total_orders"),
    )
    pairs = dated.where(F.col(other).isNotNull()).select(key, other).distinct()
    partners = (
        pairs.join(members.select(other), other, "left_semi").groupBy(key).agg(F.count(F.lit(1)).alias(counted))
    )
    return sums.join(partners, key, "left").withColumn(counted, F.coalesce(counted, F.lit(0).cast("long")))


def _kpis(as_of: dt.date, high: float, mid: float, labels: tuple[str, str, str], segment: str) -> list[Column]:
    sales, orders = F.col("_sales"), F.col("total_orders")
    lifespan = age_months("_last", "_first")
    return [
        money(sales).alias("total_sales"),
        lifespan.alias("lifespan_months"),
        age_months(F.lit(as_of), "_last").alias("recency_months"),
        money(F.round(sales / F.nullif(orders, F.lit(0)), 2)).alias("avg_order_revenue"),
        money(F.round(sales / F.nullif(lifespan, F.lit(0)), 2)).alias("avg_monthly_revenue"),
        F.when(sales > high, labels[0]).when(sales >= mid, labels[1]).otherwise(labels[2]).alias(segment),
    ]


def product_report(
    lines: DataFrame,
    products: DataFrame,
    customer_keys: DataFrame,
    as_of: dt.date,
    high: float = 50000,
    mid: float = 10000,
) -> DataFrame:
    """One row per sold product; ``lines`` carry raw ``product_id`` and ``customer_key``."""
    metrics = _per_key_metrics(lines, "product_id", "customer_key", customer_keys, "total_customers")
    return product_report_of(metrics, products, as_of, high, mid)


def product_report_of(
    metrics: DataFrame, products: DataFrame, as_of: dt.date, high: float = 50000, mid: float = 10000
) -> DataFrame:
    """The product report from metrics per ``product_id``."""
    dim = products.select("product_key", "product_id", "product_name", "category", "subcategory", "cost")
    joined = metrics.join(dim, "product_id")
    k = _kpis(as_of, high, mid, ("High-Performer", "Mid-Range", "Low-Performer"), "revenue_segment")
    return joined.select(
        "product_key",
        "product_id",
        "product_name",
        "category",
        "subcategory",
        money("cost").alias("cost"),
        "total_orders",
        k[0],
        "total_quantity",
        "total_customers",
        k[1],
        k[2],
        k[3],
        k[4],
        k[5],
    ).orderBy(F.desc_nulls_first("total_sales"))


def customer_report(
    lines: DataFrame,
    customers: DataFrame,
    product_ids: DataFrame,
    as_of: dt.date,
    high: float = 5000,
    mid: float = 1000,
) -> DataFrame:
    """One row per buying customer; ``lines`` carry raw ``product_id`` and ``customer_key``."""
    metrics = _per_key_metrics(lines, "customer_key", "product_id", product_ids, "total_products")
    return customer_report_of(metrics, customers, as_of, high, mid)


def customer_report_of(
    metrics: DataFrame, customers: DataFrame, as_of: dt.date, high: float = 5000, mid: float = 1000
) -> DataFrame:
    """The customer report from metrics per ``customer_key``."""
    dim = customers.select(
        "customer_id", "customer_key", "first_name", "last_name", "gender", "marital_status", "country", "birth_date"
    )
    joined = metrics.join(dim, "customer_key")
    k = _kpis(as_of, high, mid, ("High-Value", "Mid-Value", "Low-Value"), "spending_segment")
    return joined.select(
        "customer_id",
        "customer_key",
        "first_name",
        "last_name",
        "gender",
        "marital_status",
        "country",
        "birth_date",
        "total_orders",
        k[0],
        "total_quantity",
        "total_products",
        k[1],
        k[2],
        k[3],
        k[4],
        k[5],
    ).orderBy(F.desc_nulls_first("total_sales"))
