"""Full warehouse load: bronze, silver and gold as written layers, each read
from the one before, all switched by one commit.

A load writes every table to folders of its own (``sources.versions.Load``) and
commits once: until then, and if it is killed, the warehouse of the load before stays
as it was, tables and views. The commit record is the truth; the catalogue's tables
and views are then pointed at its folders, and ``repoint`` does so again if a load
ended between the two.

Surrogate keys come from registries beside the tables (``operators.keys``), so a
reload changes no known key. Silver and gold tables carry the ``dwh_create_date``
audit column. ``gold.fact_sales`` is a catalogue view over the load's own silver and
gold tables; the two reports are refreshed tables, so that readers do not recompute
them. Row counts of every load stay in its record: ``max_variance`` refuses a load
whose tables lost or gained too many rows.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.operators import gold, keys
from martlet.operators import silver as silver_ops
from martlet.plans import advanced
from martlet.plans.warehouse import Warehouse
from martlet.schemas import AUDIT_COLUMN, BRONZE, SILVER
from martlet.session import work_path
from martlet.sources import files, quarantine, sinks, testdata, versions


class LoadedWarehouse(Warehouse):
    """The same layers, read from the tables that a load wrote: those in the
    catalogue, or those in the given folders by ``layer.table``."""

    def __init__(self, spark: SparkSession, as_of: dt.date, paths: dict[str, str] | None = None, root: str | None = None):
        super().__init__(spark, "", as_of)
        self.paths, self.root = paths, root

    def stored(self, name: str) -> DataFrame:
        return self.spark.table(name) if self.paths is None else self.spark.read.parquet(self.paths[name])

    @cached_property
    def bronze(self) -> dict[str, DataFrame]:
        return {name: self.stored(f"bronze.{name}") for name in BRONZE}

    @cached_property
    def silver(self) -> dict[str, DataFrame]:
        return {name: self.stored(f"silver.{name}").drop(AUDIT_COLUMN) for name in SILVER}

    @cached_property
    def active_products(self) -> DataFrame:
        return gold.active_products(self.silver["crm_prd_info"], self.silver["erm_product_category"])

    @cached_property
    def dim_customers(self) -> DataFrame:
        if not self.root:
            return super().dim_customers
        known = keys.registered(self.customer_attributes, "customer_key", f"{self.root}/keys/customers", "customer_id")
        return known.select(*gold.DIM_CUSTOMER_COLUMNS)

    @cached_property
    def dim_products(self) -> DataFrame:
        if not self.root:
            return super().dim_products
        known = keys.registered(self.active_products, "_prd_id", f"{self.root}/keys/products", "product_key")
        return known.select(*gold.DIM_PRODUCT_COLUMNS)


FACT_VIEW = """
CREATE OR REPLACE VIEW gold.fact_sales AS
SELECT s.sls_ord_num AS order_number, p.product_key, c.customer_key, s.sls_order_dt AS order_date,
       s.sls_ship_dt AS shipping_date, s.sls_due_dt AS due_date, s.sls_sales AS sales_amount,
       s.sls_quantity AS quantity, s.sls_price AS unit_price
FROM parquet.`{sales}` s
LEFT JOIN parquet.`{products}` p ON p.product_id = s.sls_prd_key
LEFT JOIN parquet.`{customers}` c ON c.customer_key = s.sls_cust_id
"""


def load_warehouse(
    wh: Warehouse,
    product_segments: dict,
    customer_segments: dict,
    root: str | None = None,
    max_variance: float | None = None,
) -> dict[str, str]:
    """Write every layer below ``root`` (default: a fresh folder), commit, and
    return ``{layer.table: kind}`` for what was created."""
    spark = wh.spark
    root = root or work_path(spark, "warehouse")
    load = versions.Load(spark, root)
    paths: dict[str, str] = {}
    columns: dict[str, T.StructType] = {}

    def write(df: DataFrame, layer: str, name: str, schema: T.StructType | None = None) -> None:
        df = df if schema is None else sinks.conform(df, schema)
        df = df if layer == "bronze" else sinks.with_audit(df)
        columns[f"{layer}.{name}"] = _nullable(df.schema)
        paths[f"{layer}.{name}"] = load.write(f"{layer}.{name}", df)

    for name, schema in BRONZE.items():
        write(wh.bronze[name], "bronze", name, schema)
    loaded = LoadedWarehouse(spark, wh.as_of, paths, root)
    cleaned = silver_ops.silver_tables(loaded.bronze, wh.as_of)
    for name, schema in SILVER.items():
        write(cleaned[name], "silver", name, schema)
    write(loaded.dim_customers, "gold", "dim_customers")
    write(loaded.dim_products, "gold", "dim_products")
    products, customers = loaded.stored("gold.dim_products"), loaded.stored("gold.dim_customers")
    write(
        advanced.product_report(loaded.sales_lines, products, customers, wh.as_of, **product_segments),
        "gold",
        "rpt_product_report",
    )
    write(
        advanced.customer_report(loaded.sales_lines, customers, products, wh.as_of, **customer_segments),
        "gold",
        "rpt_customer_report",
    )
    load.commit(max_variance)
    return repoint(spark, root, columns)


def _nullable(schema: T.StructType) -> T.StructType:
    """The columns as Parquet files give them back."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


def committed(spark: SparkSession, root: str, as_of: dt.date) -> LoadedWarehouse:
    """The warehouse of the last committed load, whatever the catalogue says."""
    return LoadedWarehouse(spark, as_of, {n: s.path for n, s in versions.manifest(spark, root)[1].items()}, root)


def repoint(spark: SparkSession, root: str, columns: dict[str, T.StructType] | None = None) -> dict[str, str]:
    """Point the catalogue's tables and views at the last committed load, whose
    ``columns`` are read from the files where they are not given."""
    sinks.create_namespaces(spark, root=root)
    created: dict[str, str] = {}
    _, tables = versions.manifest(spark, root)
    for name, stored in tables.items():
        sinks.point_table(spark, name, stored.path, (columns or {}).get(name))
        created[name] = "table"
        if name == "gold.dim_products":
            paths = {"sales": "silver.crm_sales_details", "products": "gold.dim_products", "customers": "gold.dim_customers"}
            spark.sql(FACT_VIEW.format(**{k: tables[t].path for k, t in paths.items()}))
            created["gold.fact_sales"] = "view"
    return created


def _cell(f: T.StructField) -> Column:
    """A value as text that every engine writes alike: money with its decimals,
    other numbers as they are, whole doubles in cents."""
    c = F.col(f.name)
    if isinstance(f.dataType, T.DoubleType):
        c = F.round(c * 100).cast("bigint")
    return F.coalesce(c.cast("string"), F.lit("~"))


def content(df: DataFrame) -> Column:
    """Order-free digest of a table's rows: the sum of each row's md5 prefix."""
    fields = sorted((f for f in df.schema.fields if f.name != AUDIT_COLUMN), key=lambda f: f.name)
    row = F.concat_ws("|", *[_cell(f) for f in fields])
    return F.sum(F.conv(F.substring(F.md5(row), 1, 8), 16, 10).cast("bigint"))


def loaded_contents(wh: Warehouse, product_segments: dict, customer_segments: dict) -> DataFrame:
    """Run the load, then rows, content digest and rows without an audit date
    of every table and view it created, each read back once."""
    created = load_warehouse(wh, product_segments, customer_segments)
    out = None
    for qualified, kind in created.items():
        layer, name = qualified.split(".", 1)
        source = wh.spark.table(qualified)
        undated = F.count_if(F.col(AUDIT_COLUMN).isNull()) if AUDIT_COLUMN in source.columns else F.lit(0)
        part = source.agg(
            F.count(F.lit(1)).alias("row_count"), content(source).alias("content"), undated.cast("long").alias("undated")
        ).select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), F.lit(kind).alias("kind"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def csv_roundtrip(wh: Warehouse) -> DataFrame:
    """The customer, product and sales extracts written as CSV to the work
    folder and read back with the typed reader: rows and content of each."""
    out = None
    for name in ("crm_cust_info", "crm_prd_info", "crm_sales_details"):
        path = work_path(wh.spark, f"csv-{name}")
        files.write_csv(wh.bronze[name], path)
        back = files.read_csv(wh.spark, path, name)
        part = back.agg(F.count(F.lit(1)).alias("row_count"), content(back).alias("content")).select(
            F.lit(name).alias("table_name"), "*"
        )
        out = part if out is None else out.unionByName(part)
    return out


def csv_rejects(wh: Warehouse, allowed: float = 0.05) -> DataFrame:
    """A delivery of sales lines split into typed rows and quarantine: lines and
    content by reason (``accepted`` for the rows), and whether the reason's share of
    all lines is within ``allowed``."""
    path = work_path(wh.spark, "csv-delivery")
    testdata.write_delivered_sales(wh.bronze["crm_sales_details"], path)
    good, rejected = quarantine.split_csv(wh.spark, path, "crm_sales_details")
    count = F.count(F.lit(1)).alias("row_count")
    accepted = good.agg(count, content(good).alias("content")).select(F.lit("accepted").alias("reason"), "*")
    lines = rejected.select(quarantine.LINE)
    found = accepted.unionByName(
        rejected.groupBy(F.col(quarantine.REASON).alias("reason")).agg(count, content(lines).alias("content"))
    )
    # one row a reason, before all reasons meet for their total
    found = found.groupBy("reason").agg(F.sum("row_count").alias("row_count"), F.max("content").alias("content"))
    share = F.col("row_count") / F.nullif(F.sum("row_count").over(W.partitionBy()), F.lit(0))
    return found.withColumn("passed", (F.col("reason") == "accepted") | (share <= allowed))
