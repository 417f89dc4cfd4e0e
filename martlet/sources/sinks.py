"""Sinks: namespaces, full-refresh table writes with an audit column, views.

Every write is an idempotent overwrite (the truncate-and-insert of the source
system); re-running a load leaves the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.schemas import AUDIT_COLUMN

LAYERS = ("bronze", "silver", "gold")


def create_namespaces(spark: SparkSession, names: tuple[str, ...] = LAYERS, root: str | None = None) -> None:
    """Create each namespace if missing; with ``root``, its folder is placed
    there (shared storage) rather than in the session's warehouse folder."""
    for name in names:
        location = f" LOCATION '{root.rstrip('/')}/{name}.db'" if root else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{location}")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed insert: explicit column list, each value cast to the declared type
    (so a division lands rounded to the column's scale)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def with_audit(df: DataFrame) -> DataFrame:
    """Add the load timestamp column filled on insert. Never compare or hash it."""
    return df.withColumn(AUDIT_COLUMN, F.current_timestamp())


def overwrite_table(
    df: DataFrame,
    table: str,
    schema: T.StructType | None = None,
    audit: bool = True,
    path: str | None = None,
) -> None:
    """Drop-and-create / truncate-and-insert as one overwrite of a Parquet table
    (stored at ``path`` when given, else in the session's warehouse folder)."""
    if schema is not None:
        df = conform(df, schema)
    if audit:
        df = with_audit(df)
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def point_table(spark: SparkSession, table: str, path: str, columns: T.StructType | None = None) -> None:
    """Make ``table`` an external table over the Parquet files at ``path`` (with
    these ``columns``, if they are known). A table with the same columns changes
    its location in one step."""
    columns = columns or spark.read.parquet(path).schema
    if spark.catalog.tableExists(table):
        if spark.table(table).schema == columns:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
            spark.catalog.refreshTable(table)
            return
        spark.sql(f"DROP TABLE {table}")
    spark.catalog.createTable(table, path, "parquet", columns)


def overwrite_path(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def create_view(df: DataFrame, name: str) -> None:
    """Re-runnable view definition (replaces an existing one)."""
    df.createOrReplaceTempView(name)
