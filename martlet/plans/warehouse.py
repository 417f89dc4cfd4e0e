"""The warehouse as lazily built layers over one source folder.

``Warehouse`` only memoises DataFrames: bronze (bound from the source tables),
silver (cleaned), gold dimensions and fact builders. Nothing is computed until
an action runs, except the dense surrogate numbering of the two dimensions,
which stages its sorted input once (a Parquet table in the shared checkpoint
folder) per warehouse.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.operators import gold, silver
from martlet.sources import testdata

DEFAULT_AS_OF = dt.date(2002, 1, 1)


class Warehouse:
    """Layers over one source folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: dt.date = DEFAULT_AS_OF):
        self.spark = spark
        self.sf_dir = sf_dir
        self.as_of = as_of
        self._scans: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._scans:
            self._scans[name] = testdata.read_table(self.spark, self.sf_dir, name)
        return self._scans[name]

    @cached_property
    def bronze(self) -> dict[str, DataFrame]:
        return testdata.bronze_tables(self.spark, self.sf_dir, self.table)

    @cached_property
    def silver(self) -> dict[str, DataFrame]:
        return silver.silver_tables(self.bronze, self.as_of)

    @cached_property
    def silver_products_with_source_end(self) -> DataFrame:
        return silver.clean_prd_info(self.bronze["crm_prd_info"], keep_source_end=True)

    @cached_property
    def dim_customers(self) -> DataFrame:
        s = self.silver
        return gold.dim_customers(s["crm_cust_info"], s["erm_customers"], s["erm_customer_location"])

    @cached_property
    def customer_attributes(self) -> DataFrame:
        """Customer dimension without the surrogate key (no numbering job)."""
        s = self.silver
        return gold.customer_attributes(s["crm_cust_info"], s["erm_customers"], s["erm_customer_location"])

    def _current_products(self, keep_source_end: bool = False) -> DataFrame:
        prd = silver.clean_prd_info_without_end(self.bronze["crm_prd_info"], keep_source_end)
        return gold.current_versions(prd, self.silver["erm_product_category"])

    @cached_property
    def active_products(self) -> DataFrame:
        """Product dimension without the surrogate key (no numbering job);
        ``_prd_id`` identifies a row one-to-one like ``product_key`` does."""
        return self._current_products()

    @cached_property
    def dim_products(self) -> DataFrame:
        return gold.dim_products(None, None, active=self.active_products)

    @cached_property
    def current_products_with_source_end(self) -> DataFrame:
        return self._current_products(keep_source_end=True)

    @cached_property
    def dim_products_with_source_end(self) -> DataFrame:
        return gold.dim_products(None, None, active=self._current_products(keep_source_end=True))

    @cached_property
    def customer_keys(self) -> DataFrame:
        """Natural keys of the customer dimension: the silver CRM ids (the
        dimension's left joins keep exactly these)."""
        return self.silver["crm_cust_info"].select(F.col("cst_id").alias("customer_key"))

    @cached_property
    def products_by_version(self) -> DataFrame:
        """The product dimension keyed by the current version's id instead of
        the dense surrogate: for queries that use ``product_key`` only to join
        the fact to product attributes (the two keys are in one-to-one
        correspondence), this skips the numbering job."""
        return self.active_products.withColumnRenamed("_prd_id", "product_key")

    def fact_by_customer_id(self, products: bool = False, surrogate: bool = True) -> DataFrame:
        """Fact whose ``customer_key`` is the sales line's raw customer id (no
        customer join): only for queries that aggregate per customer and then
        inner-join a customer dimension, so orphan ids drop out there and the
        fact is never shuffled for the join."""
        dim = None
        if products:
            dim = self.dim_products if surrogate else self.products_by_version
        return gold.fact_sales(self.silver["crm_sales_details"], dim, None, raw_customer_key=True)

    @cached_property
    def sales_lines(self) -> DataFrame:
        """The fact with the lines' own customer ids (``customer_key``) and
        product ids (``product_id``): no dimension join. For queries that
        aggregate or de-duplicate ids first and match them afterwards."""
        return gold.fact_sales(self.silver["crm_sales_details"], raw_customer_key=True, raw_product_id=True)

    @cached_property
    def product_ids(self) -> DataFrame:
        """Natural keys of the product dimension, one-to-one with its surrogate."""
        return self.active_products.select("product_id")

    def fact(self, products: bool = True, customers: bool = True, surrogate: bool = True) -> DataFrame:
        """``fact_sales``; pass ``False`` for a dimension whose key the caller
        never reads, and that join is left out (it cannot change row counts).
        ``surrogate=False`` keys products by version id (see
        ``products_by_version``); only for queries that never output the key."""
        dim = None
        if products:
            dim = self.dim_products if surrogate else self.products_by_version
        return gold.fact_sales(self.silver["crm_sales_details"], dim, self.customer_keys if customers else None)
