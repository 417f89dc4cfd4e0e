"""The product and customer reports kept up to date from stored states.

A load adds, for each report, slices of a versioned table, committed at once:

* ``totals``: sums, first and last date of the load's lines for each key, and the
  number of orders that no earlier load had for that key;
* ``orders``, ``partners``: the distinct (key, order) and (key, partner) pairs that
  no earlier load had. Pairs of different slices are therefore disjoint, and counts
  of slices add up.

A refresh reads the load's lines and the narrow stored pairs, never a line of an
earlier load, and rewrites no stored slice. ``compact`` merges the slices of many
loads into one. Partners are matched with the dimension when the report is made, so
a member that arrives after its lines is counted from then on.

Defined cases: a load whose name is stored already is skipped, so a load that comes
twice counts once; loads may come in any order and share keys, orders and partners;
lines without a date or key count nowhere, null orders and partners are no orders
and partners; an empty load adds empty slices; without any load the metrics are
empty. Lines are added, not taken back: corrected lines need a new root.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.session import stage_table, work_path
from martlet.sources import versions
from martlet.sources.versions import Slice

#: Sums of money in the states: as wide as a decimal can be.
SALES = T.DecimalType(38, 2)
COMPACTED = "compacted"


@dataclass(frozen=True)
class Report:
    """What a report's metrics are counted by, and the partners it counts."""

    name: str
    key: str
    key_type: T.DataType
    partner: str
    partner_type: T.DataType
    counted: str

    def schema(self, part: str) -> T.StructType:
        fields = [T.StructField(self.key, self.key_type)]
        if part == "totals":
            fields += [
                T.StructField("sales", SALES),
                T.StructField("quantity", T.LongType()),
                T.StructField("first_date", T.DateType()),
                T.StructField("last_date", T.DateType()),
                T.StructField("new_orders", T.LongType()),
            ]
        elif part == "orders":
            fields.append(T.StructField("order_number", T.StringType()))
        else:
            fields.append(T.StructField(self.partner, self.partner_type))
        return T.StructType(fields)


PRODUCT = Report("product", "product_id", T.StringType(), "customer_key", T.LongType(), "total_customers")
CUSTOMER = Report("customer", "customer_key", T.LongType(), "product_id", T.StringType(), "total_products")
PARTS = ("totals", "orders", "partners")


def _slice_name(load: str, part: str) -> str:
    return f"{part}/{load}"


def _marker(load: str) -> str:
    """Manifest entry that a load was taken, kept when its slices are compacted."""
    return f"load/{load}"


def _of(slices: dict[str, Slice], part: str) -> list[Slice]:
    return [s for name, s in slices.items() if name.startswith(f"{part}/")]


def taken(spark: SparkSession, root: str) -> set[str]:
    """Names of the loads stored under ``root``."""
    _, slices = versions.manifest(spark, root)
    return {s.slice.removeprefix("load/") for s in _of(slices, "load")}


def _pairs(dated: DataFrame, report: Report, column: str) -> DataFrame:
    return dated.where(F.col(column).isNotNull()).select(report.key, column).distinct()


def add_load(lines: DataFrame, root: str, load: str, report: Report) -> bool:
    """Add ``lines`` (raw ``product_id`` and ``customer_key``) to the states under
    ``root``; False, and nothing is read, if ``load`` is stored already. ``lines``
    are read three times: give a stored table, or stage it."""
    spark = lines.sparkSession
    _, slices = versions.manifest(spark, root)
    if _marker(load) in slices:
        return False
    this = versions.Load(spark, root)
    this.tables = dict(slices)
    dated = lines.where(F.col("order_date").isNotNull() & F.col(report.key).isNotNull())
    paths = {}
    for part, column in (("orders", "order_number"), ("partners", report.partner)):
        stored = versions.read_slices(spark, _of(slices, part), report.schema(part))
        fresh = _pairs(dated, report, column).join(stored, [report.key, column], "left_anti")
        paths[part] = _write(this, load, part, fresh, report)
    orders = spark.read.schema(report.schema("orders")).parquet(paths["orders"])
    new_orders = orders.groupBy(report.key).agg(F.count(F.lit(1)).alias("new_orders"))
    sums = dated.groupBy(report.key).agg(
        F.sum("sales_amount").alias("sales"),
        F.sum("quantity").alias("quantity"),
        F.min("order_date").alias("first_date"),
        F.max("order_date").alias("last_date"),
    )
    totals = sums.join(new_orders, report.key, "left").fillna(0, ["new_orders"])
    _write(this, load, "totals", totals, report)
    this.tables[_marker(load)] = Slice(_marker(load), this.folder, 0, "")
    this.commit()
    return True


def _write(to: versions.Load, load: str, part: str, df: DataFrame, report: Report) -> str:
    """Write a part of a load's state as a slice; folders bear the part's name."""
    rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in report.schema(part)])
    path = to.write(part, rows)
    written = to.tables.pop(part)
    name = _slice_name(load, part)
    to.tables[name] = Slice(name, path, written.row_count, written.digest)
    return path


def _merged_totals(totals: DataFrame, report: Report) -> DataFrame:
    aggregates: list[Column] = [
        F.sum("sales").alias("sales"),
        F.sum("quantity").alias("quantity"),
        F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"),
        F.sum("new_orders").alias("new_orders"),
    ]
    return totals.groupBy(report.key).agg(*aggregates)


def compact(spark: SparkSession, root: str, report: Report) -> None:
    """Merge the slices of all loads into one of each part, in one commit: totals
    by key; pairs are disjoint, so they are only written together."""
    _, slices = versions.manifest(spark, root)
    this = versions.Load(spark, root)
    this.tables = {s.slice: s for s in _of(slices, "load")}
    for part in PARTS:
        stored = versions.read_slices(spark, _of(slices, part), report.schema(part))
        merged = _merged_totals(stored, report) if part == "totals" else stored.hint("rebalance")
        _write(this, COMPACTED, part, merged, report)
    this.commit()


def metrics(spark: SparkSession, root: str, report: Report, members: DataFrame) -> DataFrame:
    """Metrics per key for ``advanced.product_report_of`` or ``customer_report_of``,
    from stored states alone; partners count if ``members`` has them."""
    _, slices = versions.manifest(spark, root)
    stored = {p: versions.read_slices(spark, _of(slices, p), report.schema(p)) for p in PARTS}
    partners = stored["partners"].join(members.select(report.partner), report.partner, "left_semi")
    counted = partners.groupBy(report.key).agg(F.count(F.lit(1)).alias(report.counted))
    totals = _merged_totals(stored["totals"], report).select(
        report.key,
        F.col("sales").alias("_sales"),
        F.col("quantity").alias("total_quantity"),
        F.col("first_date").alias("_first"),
        F.col("last_date").alias("_last"),
        F.col("new_orders").alias("total_orders"),
    )
    return totals.join(counted, report.key, "left").fillna(0, [report.counted])


def stored_loads(lines: DataFrame, loads: list[tuple[str, str | Column]], report: Report) -> str:
    """``lines``, staged once, in several ``loads`` (name, condition), each added to
    new states; returns their root."""
    spark = lines.sparkSession
    root = work_path(spark, f"{report.name}-report-states")
    columns = ["product_id", "customer_key", "order_number", "order_date", "sales_amount", "quantity"]
    staged = stage_table(lines.select(*columns), f"{report.name}-report-lines")
    for name, condition in loads:
        add_load(staged.where(condition), root, name, report)
    return root
