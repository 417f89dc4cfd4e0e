"""Business analyses reported by the source project without shipped code:
quarterly trend, product-line revenue, country concentration, seasonality,
age x gender, top products with order value, gross margin, growth, revenue per
customer by country, discontinued-product exposure, version flags, text
clean-up and the headline KPI row.

Ratios are DOUBLE divisions of exact decimal totals (NULL, not an error, for a
zero denominator); rounded money ratios are rounded half-up to cents on
decimals. Shares use a window over the already aggregated rows (a handful of
groups), never over fact rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T

from martlet.functions.codes import strip_whitespace
from martlet.functions.dates import whole_years
from martlet.plans.explore import money

# Age bands in complete years at the as-of date; the source names only 35-44.
AGE_BANDS = [(None, 25, "<25"), (25, 35, "25-34"), (35, 45, "35-44"), (45, 55, "45-54"), (55, None, "55+")]


def _share(part: str, whole: Column) -> Column:
    return F.try_divide(F.col(part).cast("double"), whole.cast("double"))


def quarterly_trend(fact: DataFrame) -> DataFrame:
    return (
        fact.where(F.col("order_date").isNotNull())
        .groupBy(
            F.year("order_date").cast("long").alias("order_year"),
            F.quarter("order_date").cast("long").alias("order_quarter"),
        )
        .agg(
            money(F.sum("sales_amount")).alias("total_sales"),
            F.countDistinct("order_number").alias("total_orders"),
            F.sum("quantity").cast("long").alias("total_quantity"),
        )
        .orderBy("order_year", "order_quarter")
    )


def line_revenue(fact: DataFrame, products: DataFrame) -> DataFrame:
    per_product = (
        fact.where(F.col("product_key").isNotNull())
        .groupBy("product_key")
        .agg(F.sum("sales_amount").alias("_s"), F.sum("quantity").alias("_q"))
    )
    lines = (
        per_product.join(products.select("product_key", "product_line"), "product_key")
        .groupBy("product_line")
        .agg(F.sum("_s").alias("_s"), F.sum("_q").cast("long").alias("total_quantity"))
    )
    return lines.select(
        "product_line",
        money("_s").alias("total_sales"),
        "total_quantity",
        _share("_s", F.sum("_s").over(W.partitionBy())).alias("revenue_share"),
    ).orderBy(F.desc_nulls_first("total_sales"))


def country_share(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Revenue share per country and the cumulative share, largest first."""
    per_customer = (
        fact.where(F.col("customer_key").isNotNull()).groupBy("customer_key").agg(F.sum("sales_amount").alias("_s"))
    )
    countries = (
        per_customer.join(customers.select("customer_key", "country"), "customer_key")
        .groupBy("country")
        .agg(F.sum("_s").alias("_s"))
    )
    total = F.sum("_s").over(W.partitionBy())
    running = F.sum("_s").over(
        W.orderBy(F.desc_nulls_last("_s"), F.asc("country")).rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    return countries.select(
        "country",
        money("_s").alias("total_sales"),
        _share("_s", total).alias("revenue_share"),
        F.try_divide(running.cast("double"), total.cast("double")).alias("cumulative_share"),
    ).orderBy(F.desc_nulls_last("total_sales"), "country")


def seasonality(fact: DataFrame) -> DataFrame:
    """Revenue per calendar month over all years and its index against the
    mean month (1.0 = average month)."""
    months = (
        fact.where(F.col("order_date").isNotNull())
        .groupBy(F.month("order_date").cast("long").alias("order_month"))
        .agg(F.sum("sales_amount").alias("_s"), F.countDistinct("order_number").alias("total_orders"))
    )
    whole = W.partitionBy()
    index = F.try_divide(
        F.col("_s").cast("double") * F.count(F.lit(1)).over(whole).cast("double"),
        F.sum("_s").over(whole).cast("double"),
    )
    return months.select(
        "order_month",
        money("_s").alias("total_sales"),
        "total_orders",
        index.alias("seasonal_index"),
    ).orderBy("order_month")


def age_band(age: Column) -> Column:
    out = None
    for lo, hi, label in AGE_BANDS:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (age >= lo)
        if hi is not None:
            cond = cond & (age < hi)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return F.when(age.isNull(), "unknown").otherwise(out)


def age_gender(fact: DataFrame, customers: DataFrame, as_of: dt.date) -> DataFrame:
    """Revenue and customers per age band x gender, with the revenue share."""
    per_customer = (
        fact.where(F.col("customer_key").isNotNull()).groupBy("customer_key").agg(F.sum("sales_amount").alias("_s"))
    )
    dim = customers.select(
        "customer_key",
        age_band(whole_years(F.lit(as_of), "birth_date")).alias("age_group"),
        "gender",
    )
    groups = (
        per_customer.join(dim, "customer_key")
        .groupBy("age_group", "gender")
        .agg(F.sum("_s").alias("_s"), F.count(F.lit(1)).alias("total_customers"))
    )
    return groups.select(
        "age_group",
        "gender",
        money("_s").alias("total_sales"),
        "total_customers",
        _share("_s", F.sum("_s").over(W.partitionBy())).alias("revenue_share"),
    ).orderBy("age_group", "gender")


def _round_cents(num: Column, den: Column) -> Column:
    return money(F.round(num / F.nullif(den, F.lit(0)), 2))


def top_products_aov(fact: DataFrame, products: DataFrame, k: int = 10) -> DataFrame:
    """Top k products by revenue with average order value (revenue / orders)."""
    per_product = (
        fact.where(F.col("product_key").isNotNull())
        .groupBy("product_key")
        .agg(F.sum("sales_amount").alias("_s"), F.countDistinct("order_number").alias("total_orders"))
    )
    top = per_product.orderBy(F.desc_nulls_last("_s"), F.asc("product_key")).limit(k)
    return (
        top.join(products.select("product_key", "product_name"), "product_key")
        .select(
            "product_key",
            "product_name",
            money("_s").alias("total_sales"),
            "total_orders",
            _round_cents(F.col("_s"), F.col("total_orders")).alias("avg_order_value"),
        )
        .orderBy(F.desc_nulls_last("total_sales"), "product_key")
    )


def gross_margin(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Sales, cost of goods (quantity x product cost) and margin per category,
    plus the all-category row (``is_total = 1``) from a rollup: its
    ``gross_margin`` is blended (all sales against all costs), its
    ``mean_margin`` the plain mean of the categories' margins."""
    per_product = (
        fact.where(F.col("product_key").isNotNull())
        .groupBy("product_key")
        .agg(F.sum("sales_amount").alias("_s"), F.sum("quantity").alias("_q"))
    )
    joined = per_product.join(products.select("product_key", "category", "cost"), "product_key").withColumn(
        "_c", F.col("_q") * F.col("cost")
    )
    rolled = joined.rollup("category").agg(
        F.sum("_s").alias("_s"), F.sum("_c").alias("_c"), F.grouping("category").cast("int").alias("is_total")
    )
    margin = F.try_divide((F.col("_s") - F.col("_c")).cast("double"), F.col("_s").cast("double"))
    # a window over one row per category
    mean = F.avg(F.when(F.col("is_total") == 0, margin)).over(W.partitionBy())
    return rolled.select(
        "category",
        "is_total",
        money("_s").alias("total_sales"),
        money("_c").alias("total_cost"),
        margin.alias("gross_margin"),
        F.when(F.col("is_total") == 1, F.round(mean, 9)).alias("mean_margin"),
    ).orderBy("is_total", F.desc_nulls_last("total_sales"))


def yoy_growth(fact: DataFrame, base_year: int | None = None) -> DataFrame:
    """Yearly revenue, growth against the previous year and against a base year
    (the first year when ``base_year`` is None), in percent."""
    from martlet.plans.advanced import yearly_sales

    years = yearly_sales(fact)
    by_year = W.orderBy("order_year")
    whole = W.partitionBy()
    base = (
        F.first("_total").over(by_year.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
        if base_year is None
        else F.max(F.when(F.col("order_year") == base_year, F.col("_total"))).over(whole)
    )
    staged = years.withColumn("_prev", F.lag("_total").over(by_year)).withColumn("_base", base)

    def pct(a: str, b: str) -> Column:
        return F.try_divide((F.col(a) - F.col(b)).cast("double"), F.col(b).cast("double")) * 100.0

    return staged.select(
        "order_year",
        money("_total").alias("total_sales"),
        money("_prev").alias("prev_year_sales"),
        pct("_total", "_prev").alias("yoy_growth_pct"),
        pct("_total", "_base").alias("growth_vs_base_pct"),
    ).orderBy("order_year")


def revenue_per_customer_country(fact: DataFrame, customers: DataFrame) -> DataFrame:
    per_customer = (
        fact.where(F.col("customer_key").isNotNull()).groupBy("customer_key").agg(F.sum("sales_amount").alias("_s"))
    )
    countries = (
        per_customer.join(customers.select("customer_key", "country"), "customer_key")
        .groupBy("country")
        .agg(F.sum("_s").alias("_s"), F.count(F.lit(1)).alias("total_customers"))
    )
    return countries.select(
        "country",
        money("_s").alias("total_sales"),
        "total_customers",
        _round_cents(F.col("_s"), F.col("total_customers")).alias("revenue_per_customer"),
    ).orderBy(F.desc_nulls_last("revenue_per_customer"), "country")


def discontinued_share(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue of products whose current version carries a source end date
    (discontinued) against the rest. ``products`` needs ``src_end_date``."""
    per_product = (
        fact.where(F.col("product_key").isNotNull()).groupBy("product_key").agg(F.sum("sales_amount").alias("_s"))
    )
    status = F.when(F.col("src_end_date").isNotNull(), "Discontinued").otherwise("Active")
    groups = (
        per_product.join(products.select("product_key", status.alias("product_status")), "product_key")
        .groupBy("product_status")
        .agg(F.sum("_s").alias("_s"), F.count(F.lit(1)).alias("total_products"))
    )
    return groups.select(
        "product_status",
        "total_products",
        money("_s").alias("total_sales"),
        _share("_s", F.sum("_s").over(W.partitionBy())).alias("revenue_share"),
    )


def version_flags(silver_products: DataFrame) -> DataFrame:
    """Per product version: current flag and whether the discarded source end
    date preceded the start. ``silver_products`` needs ``src_prd_end_dt``."""
    return silver_products.select(
        "prd_id",
        "prd_key",
        "prd_start_dt",
        "prd_end_dt",
        "src_prd_end_dt",
        F.col("prd_end_dt").isNull().alias("is_current"),
        F.coalesce(F.col("src_prd_end_dt") < F.col("prd_start_dt"), F.lit(False)).alias("src_end_before_start"),
    )


def strip_text_columns(df: DataFrame) -> DataFrame:
    """Remove leading/trailing whitespace of every text column."""
    return df.select(
        *[
            strip_whitespace(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )
