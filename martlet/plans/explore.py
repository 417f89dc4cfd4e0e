"""Exploratory queries over the gold star: KPIs, dimension breakdowns, revenue
by category / customer / country, and top / bottom products.

Every function takes gold DataFrames and returns a DataFrame. Money totals are
summed exactly as decimals and only the final value is a DOUBLE. Joins of the
fact to a dimension aggregate the fact to the join key first (map-side partial
aggregation), so only one row per key crosses the join and a hot key is
combined before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def money(c: str | Column) -> Column:
    """Final money value: exact decimal in, DOUBLE out."""
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def order_date_range(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.min("order_date").alias("min_order_date"),
        F.max("order_date").alias("max_order_date"),
    )


def total_sales(fact: DataFrame) -> DataFrame:
    return fact.agg(money(F.sum("sales_amount")).alias("total_sales"))


def total_quantity(fact: DataFrame) -> DataFrame:
    return fact.agg(F.sum("quantity").cast("long").alias("total_quantity"))


def avg_unit_price(fact: DataFrame) -> DataFrame:
    return fact.agg(money(F.avg("unit_price")).alias("avg_unit_price"))


def distinct_customers(
    fact: DataFrame, name: str = "distinct_customers", customers: DataFrame | None = None
) -> DataFrame:
    """``total_order_number`` in the source is this same customer count under a
    misleading name; pass ``name`` to reproduce it. With ``customers`` (valid
    keys) the fact may carry raw sales customer ids: the distinct ids are
    found first (partial aggregation) and only they are matched."""
    if customers is None:
        return fact.agg(F.countDistinct("customer_key").alias(name))
    ids = fact.where(F.col("customer_key").isNotNull()).select("customer_key").distinct()
    return ids.join(customers.select("customer_key"), "customer_key", "left_semi").agg(
        F.count(F.lit(1)).alias(name)
    )


def matched_ids(lines: DataFrame, column: str, members: DataFrame) -> DataFrame:
    """The distinct ids of ``column`` that a dimension knows: de-duplicated in
    each map task first, so only ids, never lines, are shuffled and matched."""
    ids = lines.where(F.col(column).isNotNull()).select(column).distinct()
    return ids.join(members.select(column), column, "left_semi")


def _counted(lines: DataFrame, customers: DataFrame, products: DataFrame, sums: list[Column]) -> DataFrame:
    """One row: ``sums`` and ``orders`` over the lines (one distinct column, so
    no row is expanded), and the matched ``customers`` and ``products``."""
    names = ["customers", "products"]
    own = lines.agg(*sums, F.countDistinct("order_number").alias("orders"))
    columns = own.columns
    parts = [own.select(*columns, *[F.lit(None).cast("long").alias(n) for n in names])]
    for name, ids in zip(
        names, (matched_ids(lines, "customer_key", customers), matched_ids(lines, "product_id", products))
    ):
        n = ids.agg(F.count(F.lit(1)).alias(name))
        empty = [F.lit(None).cast(own.schema[c].dataType).alias(c) for c in columns]
        parts.append(n.select(*empty, *[F.col(name) if m == name else F.lit(None).cast("long").alias(m) for m in names]))
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])  # three rows, made one
    return rows.agg(*[F.max(c).alias(c) for c in [*columns, *names]])


def distinct_counts(lines: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """The three distinct counts of the KPI list."""
    return _counted(lines, customers, products, []).select(
        F.col("customers").alias("distinct_customers"),
        F.col("products").alias("distinct_products"),
        F.col("orders").alias("distinct_orders"),
    )


def distinct_products(fact: DataFrame) -> DataFrame:
    return fact.agg(F.countDistinct("product_key").alias("distinct_products"))


def distinct_orders(fact: DataFrame) -> DataFrame:
    return fact.agg(F.countDistinct("order_number").alias("distinct_orders"))


KPI_METRICS = [
    ("Total sales", "total_sales"),
    ("Total quantity", "total_quantity"),
    ("Average unit price", "avg_unit_price"),
    ("Distinct customers", "distinct_customers"),
    ("Distinct products", "distinct_products"),
    ("Distinct orders", "distinct_orders"),
]


def kpi_summary(lines: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """(metric, value) list of six KPIs: sums over the unjoined lines, distinct
    counts of de-duplicated ids, and ``stack`` to turn the row into six."""
    sums = [
        F.sum("sales_amount").alias("sales"),
        F.sum("quantity").alias("quantity"),
        F.avg("unit_price").alias("price"),
    ]
    one = _counted(lines, customers, products, sums).select(
        money("sales").alias("total_sales"),
        F.col("quantity").cast("double").alias("total_quantity"),
        money("price").alias("avg_unit_price"),
        F.col("customers").cast("double").alias("distinct_customers"),
        F.col("products").cast("double").alias("distinct_products"),
        F.col("orders").cast("double").alias("distinct_orders"),
    )
    args = ", ".join(f"'{label}', {col}" for label, col in KPI_METRICS)
    return one.select(F.expr(f"stack({len(KPI_METRICS)}, {args}) AS (metric, value)"))


def headline_kpis(lines: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    one = _counted(lines, customers, products, [F.sum("sales_amount").alias("sales")])
    return one.select(
        money("sales").alias("total_revenue"),
        F.col("orders").alias("total_orders"),
        money(F.round(F.col("sales") / F.nullif(F.col("orders"), F.lit(0)), 2)).alias("avg_order_value"),
        F.col("customers").alias("unique_customers"),
        F.col("products").alias("products_sold"),
    )


def customers_by_dimension(customers: DataFrame, column: str) -> DataFrame:
    return customers.groupBy(column).agg(F.countDistinct("customer_key").alias("total_customers"))


def customers_by_country(customers: DataFrame) -> DataFrame:
    return customers_by_dimension(customers, "country")


def customers_by_gender(customers: DataFrame) -> DataFrame:
    return customers_by_dimension(customers, "gender")


def products_by_category(products: DataFrame, key: str = "product_key") -> DataFrame:
    """Distinct products per category; a NULL category is its own group.
    ``key`` may be any column that identifies a product row one-to-one."""
    return products.groupBy("category").agg(F.countDistinct(key).alias("total_products"))


def avg_cost_by_category(products: DataFrame) -> DataFrame:
    return (
        products.groupBy("category")
        .agg(money(F.avg("cost")).alias("avg_cost"))
        .orderBy(F.desc_nulls_first("avg_cost"))
    )


def _sales_per(fact: DataFrame, key: str, *measures: str) -> DataFrame:
    """Pre-aggregate the fact to one row per dimension key (rows with a NULL key
    cannot match an inner join and are dropped first)."""
    aggs = [F.sum(m).alias(m) for m in measures]
    return fact.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)


def sales_by_category(fact: DataFrame, products: DataFrame) -> DataFrame:
    per_product = _sales_per(fact, "product_key", "sales_amount")
    return (
        per_product.join(products.select("product_key", "category"), "product_key")
        .groupBy("category")
        .agg(money(F.sum("sales_amount")).alias("total_sales"))
        .orderBy(F.desc_nulls_first("total_sales"))
    )


def revenue_per_customer(fact: DataFrame, customers: DataFrame) -> DataFrame:
    per_customer = _sales_per(fact, "customer_key", "sales_amount")
    return (
        per_customer.join(customers.select("customer_key", "first_name", "last_name"), "customer_key")
        .groupBy("customer_key", "first_name", "last_name")
        .agg(money(F.sum("sales_amount")).alias("total_revenue"))
        .orderBy(F.desc_nulls_first("total_revenue"))
    )


def quantity_by_country(fact: DataFrame, customers: DataFrame) -> DataFrame:
    per_customer = _sales_per(fact, "customer_key", "quantity")
    return (
        per_customer.join(customers.select("customer_key", "country"), "customer_key")
        .groupBy("country")
        .agg(F.sum("quantity").cast("long").alias("total_quantity"))
        .orderBy(F.desc_nulls_first("total_quantity"))
    )


def revenue_by_product_name(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue grouped by product *name* (names repeat across products)."""
    per_product = _sales_per(fact, "product_key", "sales_amount")
    return (
        per_product.join(products.select("product_key", "product_name"), "product_key")
        .groupBy("product_name")
        .agg(F.sum("sales_amount").alias("_revenue"))
    )


def top_products(fact: DataFrame, products: DataFrame, k: int = 5) -> DataFrame:
    """k highest-revenue product names; ties broken by name so the cut is stable.
    Planned as ``TakeOrderedAndProject``: each task keeps its own top k."""
    return (
        revenue_by_product_name(fact, products)
        .orderBy(F.desc_nulls_first("_revenue"), F.asc("product_name"))
        .limit(k)
        .select("product_name", money("_revenue").alias("total_revenue"))
    )


def bottom_products(fact: DataFrame, products: DataFrame, k: int = 5) -> DataFrame:
    """k lowest-revenue product names with their row number. The limit is taken
    first, so the un-partitioned row number only ever sees k rows."""
    lowest = (
        revenue_by_product_name(fact, products)
        .orderBy(F.asc_nulls_last("_revenue"), F.asc("product_name"))
        .limit(k)
    )
    w = W.orderBy(F.asc_nulls_last("_revenue"), F.asc("product_name"))
    return lowest.select(
        "product_name",
        money("_revenue").alias("total_revenue"),
        F.row_number().over(w).cast("long").alias("row_num"),
    ).orderBy("row_num")
