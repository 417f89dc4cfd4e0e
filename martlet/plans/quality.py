"""Cleaning audit and data-quality checks between bronze, silver and gold.

Each table contributes one single-pass conditional aggregate (one scan, one
row), which ``stack`` turns into (table, metric, value) rows. Checks compare
measured rates against thresholds from a small rule list.
"""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.functions import codes, dates
from martlet.session import work_path
from martlet.sources import versions

if TYPE_CHECKING:
    from martlet.plans.warehouse import Warehouse

NOT_AVAILABLE = codes.NOT_AVAILABLE


def _count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("double")


def _stack(one_row: DataFrame, table: str) -> DataFrame:
    """Every column of a one-row aggregate -> (table_name, metric, value) rows."""
    metrics = [c for c in one_row.columns]
    args = ", ".join(f"'{m}', CAST(`{m}` AS DOUBLE)" for m in metrics)
    return one_row.select(
        F.lit(table).alias("table_name"), F.expr(f"stack({len(metrics)}, {args}) AS (metric, value)")
    )


def _stack_pairs(one_row: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """(table, metric) per column of a one-row aggregate -> (table_name, metric, value) rows."""
    args = ", ".join(f"'{t}', '{m}', CAST(`{m}` AS DOUBLE)" for t, m in pairs)
    return one_row.select(F.expr(f"stack({len(pairs)}, {args}) AS (table_name, metric, value)"))


def cleaning_audit(wh: Warehouse, customers: DataFrame) -> DataFrame:
    """What the cleaning did, per table: rows in/out, superseded versions,
    repaired money, invalid dates, normalised keys and countries, gender gaps
    before and after the merge, fact key match rates.

    The sales metrics of all three layers come from one pass: the bronze
    lines with their cleaned values and dimension keys side by side."""
    bronze, silver = wh.bronze, wh.silver
    parts = []

    parts.append(_stack(bronze["crm_cust_info"].agg(F.count(F.lit(1)).alias("bronze_rows")), "crm_cust_info"))
    parts.append(
        _stack(
            silver["crm_cust_info"].agg(
                F.count(F.lit(1)).alias("silver_rows"),
                _count_if(F.col("cst_gndr") == NOT_AVAILABLE).alias("gender_na_rows"),
            ),
            "crm_cust_info",
        )
    )

    parts.append(
        _stack(
            bronze["crm_prd_info"].agg(
                F.count(F.lit(1)).alias("bronze_rows"),
                _count_if(F.col("prd_cost").isNull()).alias("null_cost_filled"),
                _count_if(F.col("prd_end_dt") < F.col("prd_start_dt")).alias("source_end_before_start"),
            ),
            "crm_prd_info",
        )
    )
    # superseded versions = all versions - current versions (those whose
    # rebuilt end date is NULL), from two one-row counts
    versions = bronze["crm_prd_info"].agg(F.count(F.lit(1)).alias("_n")).unionByName(
        wh.active_products.agg((-F.count(F.lit(1))).alias("_n"))
    )
    parts.append(
        _stack(versions.agg(F.sum("_n").alias("superseded_versions")), "crm_prd_info")
    )

    s, q, p = F.col("sls_sales"), F.col("sls_quantity"), F.col("sls_price")
    lines = bronze["crm_sales_details"].select(
        "sls_prd_key",
        "sls_cust_id",
        (s.isNull() | (s <= 0) | (s != F.abs(q) * F.abs(p))).alias("_recalc"),
        (p.isNull() | (p <= 0)).alias("_reprice"),
        dates.decode_yyyymmdd_guarded("sls_order_dt").isNull().alias("_bad_order_dt"),
        dates.decode_yyyymmdd("sls_ship_dt").isNull().alias("_bad_ship_dt"),
    )
    keyed_lines = lines.alias("l").join(
        wh.products_by_version.select("product_key", "product_id").alias("dp"),
        F.col("l.sls_prd_key") == F.col("dp.product_id"),
        "left",
    ).join(wh.customer_keys.alias("dc"), F.col("l.sls_cust_id") == F.col("dc.customer_key"), "left")
    n = F.count(F.lit(1))
    sales = keyed_lines.agg(
        n.alias("bronze_rows"),
        _count_if(F.col("_recalc")).alias("sales_recalculated"),
        _count_if(F.col("_reprice")).alias("price_repaired"),
        _count_if(F.col("_bad_order_dt")).alias("order_date_invalid"),
        _count_if(F.col("_bad_ship_dt")).alias("ship_date_invalid"),
        n.alias("fact_rows"),
        F.try_divide(F.count("dp.product_key"), n).alias("product_match_rate"),
        F.try_divide(F.count("dc.customer_key"), n).alias("customer_match_rate"),
    )
    parts.append(
        _stack_pairs(
            sales,
            [
                ("crm_sales_details", "bronze_rows"),
                ("crm_sales_details", "sales_recalculated"),
                ("crm_sales_details", "price_repaired"),
                ("crm_sales_details", "order_date_invalid"),
                ("crm_sales_details", "ship_date_invalid"),
                ("gold", "fact_rows"),
                ("gold", "product_match_rate"),
                ("gold", "customer_match_rate"),
            ],
        )
    )

    parts.append(
        _stack(
            bronze["erm_customers"].agg(
                F.count(F.lit(1)).alias("bronze_rows"),
                _count_if(F.col("cid").startswith(codes.CUSTOMER_ID_PREFIX)).alias("prefix_stripped"),
                _count_if(F.col("birth_date") > F.lit(wh.as_of)).alias("future_birth_dates"),
            ),
            "erm_customers",
        )
    )

    t = F.trim("country")
    parts.append(
        _stack(
            bronze["erm_customer_location"].agg(
                F.count(F.lit(1)).alias("bronze_rows"),
                _count_if(F.col("cid").contains("-")).alias("dash_removed"),
                _count_if(t.isin(*codes.COUNTRY_CODES)).alias("country_code_mapped"),
                _count_if(F.col("country").isNull() | (t == "")).alias("country_unknown"),
            ),
            "erm_customer_location",
        )
    )

    parts.append(
        _stack(
            customers.agg(
                F.try_divide(_count_if(F.col("gender") == NOT_AVAILABLE), F.count(F.lit(1))).alias("gender_na_rate")
            ),
            "gold",
        )
    )

    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def row_count_variance(spark: SparkSession, root: str, threshold: float) -> DataFrame:
    """Each table of the last two loads at ``root``: rows before and now, the share
    by which they differ, and whether that is within ``threshold``. A table that is
    gone counts as empty; a new one, or one that was empty, has no variance and
    passes. One line for each table, from the loads' records."""
    loads: dict[int, dict[str, int]] = {}
    for version, table in versions.history(spark, root):
        loads.setdefault(version, {})[table.slice] = table.row_count
    now = loads.get(max(loads, default=0), {})
    before = loads.get(max(loads, default=0) - 1, {})
    rows = []
    for name in sorted(before.keys() | now.keys()):
        change = versions.variance(before.get(name), now.get(name))
        rows.append((name, before.get(name), now.get(name, 0), change, threshold, change is None or change <= threshold))
    schema = "table_name string, previous_rows long, row_count long, variance double, threshold double, passed boolean"
    return spark.createDataFrame(rows, schema)


def variance_of_second_load(first: dict[str, DataFrame], second: dict[str, DataFrame], threshold: float) -> DataFrame:
    """Load two deliveries of the same tables one after the other and compare them."""
    spark = next(iter(first.values())).sparkSession
    root = work_path(spark, "deliveries")
    for tables in (first, second):
        load = versions.Load(spark, root)
        for name, df in tables.items():
            load.write(name, df)
        load.commit()
    return row_count_variance(spark, root, threshold)


# (check name, audit table, audit metric or ratio, threshold): passed = measured <= threshold
DQ_RULES = [
    ("customer_row_loss_rate", "crm_cust_info", ("bronze_rows", "silver_rows"), 0.05),
    ("crm_gender_na_rate", "crm_cust_info", ("gender_na_rows", "silver_rows"), 0.5),
    ("invalid_order_date_rate", "crm_sales_details", ("order_date_invalid", "bronze_rows"), 0.05),
    ("sales_repair_rate", "crm_sales_details", ("sales_recalculated", "bronze_rows"), 0.5),
    ("future_birth_date_rate", "erm_customers", ("future_birth_dates", "bronze_rows"), 0.01),
    ("unknown_country_rate", "erm_customer_location", ("country_unknown", "bronze_rows"), 0.05),
    ("merged_gender_na_rate", "gold", ("gender_na_rate", None), 0.25),
    ("product_key_mismatch_rate", "gold", ("product_match_rate", None), 0.01),
    ("customer_key_mismatch_rate", "gold", ("customer_match_rate", None), 0.01),
]


def dq_checks(audit: DataFrame) -> DataFrame:
    """Measured rate per rule, its threshold and pass/fail. Match rates are
    turned into mismatch rates (1 - rate). The audit (a few dozen rows) is
    pivoted into one row, every rule is evaluated on it in one projection, and
    ``stack`` turns the rules back into rows -- one pass over the audit."""
    keys = sorted({f"{t}.{m}" for _, t, pair, _ in DQ_RULES for m in pair if m})
    wide = (
        audit.withColumn("_k", F.concat_ws(".", "table_name", "metric"))
        .groupBy()
        .pivot("_k", keys)
        .agg(F.first("value"))
    )

    def col(table: str, metric: str) -> Column:
        return F.col(f"`{table}.{metric}`")

    exprs = []
    for name, table, (num, den), _ in DQ_RULES:
        if den is None:
            measured = col(table, num)
            if num.endswith("match_rate"):
                measured = F.lit(1.0) - measured
        elif name.endswith("loss_rate"):
            # rows lost between layers, relative to the input
            measured = F.try_divide(col(table, num) - col(table, den), col(table, num))
        else:
            measured = F.try_divide(col(table, num), col(table, den))
        exprs.append(measured.cast("double").alias(name))
    measured_row = wide.select(*exprs)
    args = ", ".join(f"'{name}', `{name}`, CAST({float(th)!r} AS DOUBLE)" for name, _, _, th in DQ_RULES)
    rules = measured_row.select(F.expr(f"stack({len(DQ_RULES)}, {args}) AS (check_name, measured, threshold)"))
    # a rate that could not be measured has not passed
    return rules.withColumn("passed", F.coalesce(F.col("measured") <= F.col("threshold"), F.lit(False)))
