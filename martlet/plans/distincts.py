"""Distinct customers, orders and products of any period from stored daily states.

Each load adds the states of its own lines (``operators.bitmaps``) as a slice of a
versioned table, committed at once; counts read states only. Loads may overlap in
days, customers and orders, come in any order or come twice: merging changes no
count. Text keys are numbered by registries beside the states, which keep a key's
number from load to load; orders are numbered by day, so a day's orders share few
bitmaps. A load's lines are read once, to distinct pairs of a day and a key, which
alone are numbered and counted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.operators import bitmaps, keys
from martlet.session import stage_table, work_path
from martlet.sources import versions

COUNTED = ["customers", "orders", "products"]
SCHEMA = T.StructType(
    [
        T.StructField("day", T.DateType()),
        T.StructField("counted", T.StringType()),
        T.StructField("bucket", T.LongType()),
        T.StructField("bitmap", T.BinaryType()),
    ]
)


def add_load(sales: DataFrame, root: str) -> None:
    """Store the daily states of silver ``sales`` lines as one more slice."""
    spark = sales.sparkSession
    def named(counted: str, of: str, kind: str) -> Column:
        value = {k: F.col(of) if k == kind else F.lit(None) for k in ("bigint", "string")}
        return F.struct(
            F.lit(counted).alias("counted"), value["bigint"].cast("bigint").alias("id"), value["string"].cast("string").alias("key")
        )

    found = F.array(
        named("customers", "sls_cust_id", "bigint"), named("orders", "sls_ord_num", "string"), named("products", "sls_prd_key", "string")
    )
    pairs = sales.select(F.col("sls_order_dt").alias("day"), F.inline(found))
    pairs = stage_table(pairs.where("id is not null or key is not null").distinct(), "day-keys")

    def ids_of(counted: str) -> DataFrame:
        return pairs.where(F.col("counted") == counted)

    orders = ids_of("orders").select("day", F.col("key").alias("sls_ord_num"))
    orders = keys.registered(orders, "sls_ord_num", f"{root}/order-keys", "orders", near="day")
    products = ids_of("products").select("day", F.col("key").alias("sls_prd_key"))
    products = keys.registered(products, "sls_prd_key", f"{root}/product-keys", "products")
    customers = ids_of("customers").select("day", F.col("id").alias("customers"))
    parts = [bitmaps.states(rows, ["day"], [c]) for c, rows in zip(COUNTED, (customers, orders, products))]
    at = f"{root}/states"
    _, slices = versions.manifest(spark, at)
    load = versions.Load(spark, at)
    load.tables = dict(slices)
    load.write(f"load-{load.version}", reduce(DataFrame.unionByName, parts))
    load.commit()


def stored_states(spark: SparkSession, root: str) -> DataFrame:
    _, slices = versions.manifest(spark, f"{root}/states")
    return versions.read_slices(spark, list(slices.values()), SCHEMA)


def period_counts(states: DataFrame) -> DataFrame:
    """Distinct counts by month (``yyyy-MM``; ``undated`` lines apart) and of ``all``."""
    month = F.coalesce(F.date_format("day", "yyyy-MM"), F.lit("undated")).alias("period")
    # the total is merged from the months' states, not from the days' again
    months = bitmaps.merged(states, [month])
    by_month = bitmaps.counts(months, [F.col("period")], COUNTED)
    return by_month.unionByName(bitmaps.counts(months, [F.lit("all").alias("period")], COUNTED))


def counts_over_loads(sales: DataFrame, loads: list) -> DataFrame:
    """``sales`` in several ``loads`` (conditions on day and counted columns, which
    may overlap), each stored as states; then all periods from the states."""
    spark = sales.sparkSession
    # the lines are built once, not once a load
    sales = stage_table(sales.select("sls_order_dt", "sls_cust_id", "sls_ord_num", "sls_prd_key"), "counted-lines")
    root = work_path(spark, "distinct-states")
    for lines in loads:
        add_load(sales.where(lines), root)
    return period_counts(stored_states(spark, root))
