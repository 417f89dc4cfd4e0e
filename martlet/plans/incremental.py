"""Incremental loads: changed slices by manifest, and change-data merge.

Both keep their target as a versioned table (``sources.versions``): a run writes
only the slices or buckets that changed, to folders of its own, and one commit
switches readers. Targets lie under the session's checkpoint folder (shared storage
on a cluster) unless a path is given.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.operators.windows import latest_per_key
from martlet.session import stage_table, work_path
from martlet.sources import versions
from martlet.sources.versions import Slice

CUSTOMER_SNAPSHOT = (
    "cst_id", "cst_key", "cst_firstname", "cst_lastname", "cst_marital_status", "cst_gndr", "cst_create_date"
)


#: The slice of rows without a date.
UNDATED = "undated"
#: Length of a slice by name.
GRAINS = {"MONTH": 1, "QUARTER": 3, "YEAR": 12}


def slice_of(date: Column, grain: str) -> Column:
    """Name of a row's slice: the first day of its month, quarter or year."""
    if grain not in GRAINS:
        raise ValueError(f"grain {grain!r} is none of {sorted(GRAINS)}")
    return F.coalesce(F.trunc(date, grain).cast("string"), F.lit(UNDATED))


def in_slices(date: Column, names: list[str], grain: str) -> Column:
    """Rows of the named slices, as date ranges that reach the source's scan;
    neighbouring slices are one range."""
    found = date.isNull() if UNDATED in names else F.lit(False)
    ranges: list[list[dt.date]] = []
    for first in sorted(dt.date.fromisoformat(n) for n in names if n != UNDATED):
        months = first.year * 12 + first.month - 1 + GRAINS[grain]
        after = dt.date(months // 12, months % 12 + 1, 1)
        if ranges and ranges[-1][1] == first:
            ranges[-1][1] = after
        else:
            ranges.append([first, after])
    for first, after in ranges:
        found = found | ((date >= F.lit(first)) & (date < F.lit(after)))
    return found


def load_changed_slices(
    spark: SparkSession, target: str, source: DataFrame, date_col: str, grain: str = "QUARTER"
) -> tuple[DataFrame, list[str]]:
    """Bring ``target`` up to ``source``; returns the target and the slices loaded.

    The target's manifest holds date range, row count and row digest of every
    slice. One aggregate over the source measures its slices; those that differ
    from the manifest, late and corrected rows and undated ones included, are read
    as date ranges and replace the target's. Slices that the source no longer holds
    stay. A run over an unchanged source reads no row twice and writes nothing.
    ``source`` is read once or twice: give a stored table, or stage it."""
    version, slices = versions.manifest(spark, target)
    day = F.col(date_col).cast("date")
    found = versions.measured(source, slice_of(day, grain))
    changed = [
        (name, rows, digest)
        for name, rows, digest in found
        if name not in slices or (slices[name].row_count, slices[name].digest) != (rows, digest)
    ]
    if changed or version is None:
        version = 0 if version is None else version + 1
        folder = versions.new_folder(target, version)
        names = sorted(name for name, _, _ in changed)
        if changed:
            versions.write_folders(source.where(in_slices(F.col(date_col), names, grain)), slice_of(day, grain), folder)
        slices |= {n: Slice(n, versions.slice_path(folder, n), rows, digest) for n, rows, digest in changed}
        versions.commit(spark, target, version, list(slices.values()))
    return versions.read_slices(spark, list(slices.values()), source.schema), sorted(n for n, _, _ in changed)


def incremental_load(spark: SparkSession, source: DataFrame, date_col: str, initial_before: dt.date) -> DataFrame:
    """Initial load of the rows dated before ``initial_before``, then one
    incremental run over the whole source, which loads only the slices that the
    first did not. The source is derived once, to a staged table. Every source row
    is in the target once, those without a date included."""
    target = work_path(spark, "incremental")
    source = stage_table(source, "incremental-source")
    load_changed_slices(spark, target, source.where(F.col(date_col) < F.lit(initial_before)), date_col)
    return load_changed_slices(spark, target, source, date_col)[0]


def customer_change_feed(orders: DataFrame) -> DataFrame:
    """A change record per order for its customer: an update of the marital
    status, or a delete for urgent orders that are already fulfilled."""
    return orders.select(
        F.col("o_custkey").alias("cst_id"),
        F.concat(F.lit("AW"), F.col("o_custkey").cast("string")).alias("cst_key"),
        F.when(F.col("o_orderkey") % 2 == 0, "Married").otherwise("Single").alias("cst_marital_status"),
        F.col("o_orderdate").cast("date").alias("change_date"),
        F.col("o_orderkey").alias("change_seq"),
        F.when((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"), "D")
        .otherwise("U")
        .alias("op"),
    )


def merged(base: DataFrame, changes: DataFrame) -> DataFrame:
    """A change feed merged into a snapshot keyed by ``cst_id``.

    Of each key's changes the latest (by date, then sequence) counts, if it is
    not older than the snapshot row (its ``last_change_date``, or its create
    date). An update lays its columns over the snapshot row, whose other columns
    stay; a key that only the feed knows becomes a new row; a delete removes the
    key. Keep-latest is cut to a row for each key and map task before it moves."""
    latest = latest_per_key(changes, "cst_id", [F.desc_nulls_last("change_date"), F.desc("change_seq")])
    feed = latest.select(
        F.col("cst_id").alias("ch_id"),
        F.col("cst_key").alias("ch_key"),
        F.col("cst_marital_status").alias("ch_marital"),
        "change_date",
        "op",
    )
    known = base if "last_change_date" in base.columns else base.withColumn("last_change_date", F.col("cst_create_date"))
    if "source" not in known.columns:
        known = known.withColumn("source", F.lit("base"))
    both = known.join(feed, known["cst_id"] == F.col("ch_id"), "full_outer")
    # an undated change is older than a dated row
    older = F.coalesce(F.col("change_date") < F.col("last_change_date"), F.col("last_change_date").isNotNull())
    takes = F.col("ch_id").isNotNull() & (F.col("cst_id").isNull() | ~older)
    columns = {
        "cst_id": F.coalesce("cst_id", "ch_id"),
        "cst_key": F.when(takes, F.col("ch_key")).otherwise(F.col("cst_key")),
        "cst_marital_status": F.when(takes, F.col("ch_marital")).otherwise(F.col("cst_marital_status")),
        "last_change_date": F.when(takes, F.col("change_date")).otherwise(F.col("last_change_date")),
        "source": F.when(takes, F.lit("change")).otherwise(F.col("source")),
    }
    out = both.where(~(takes & (F.col("op") == "D")))
    return out.select(*[columns.get(c, F.col(c)).alias(c) for c in [*CUSTOMER_SNAPSHOT, "last_change_date", "source"]])


#: Buckets of a merge target; choose them so that one fits a task.
BUCKETS = 16


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("string")


def _snapshot(base: DataFrame) -> DataFrame:
    """The target's columns of a first snapshot."""
    return base.select(
        *CUSTOMER_SNAPSHOT, F.col("cst_create_date").alias("last_change_date"), F.lit("base").alias("source")
    )


def cdc_merge(
    base: DataFrame, changes: DataFrame, target_path: str | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """Merge ``changes`` into the target at ``target_path`` (created from ``base``
    where there is none) and return it.

    The target is bucketed by a hash of the key. Only buckets that some change
    falls into are read and written anew; of those, only the ones whose rows really
    differ (by count and digest) are committed, so all others keep their files and a
    rerun of the same changes commits nothing."""
    spark = base.sparkSession
    target = target_path or work_path(spark, "customers")
    version, slices = versions.manifest(spark, target)
    bucket = bucket_of(F.col("cst_id"), buckets)
    if version is None:
        version, slices = 0, _replaced(target, _snapshot(base), bucket, 0, {})
    schema = _snapshot(base).schema
    # the names of at most ``buckets`` buckets
    touched = {r[0] for r in changes.where("cst_id is not null").select(bucket.alias("b")).distinct().collect()}
    if touched:
        current = versions.read_slices(spark, [s for n, s in slices.items() if n in touched], schema)
        slices = _replaced(target, merged(current, changes), bucket, version + 1, slices, touched)
    return versions.read_slices(spark, list(slices.values()), schema)


def _replaced(
    target: str, rows: DataFrame, bucket: Column, version: int, slices: dict[str, Slice], touched: set[str] | None = None
) -> dict[str, Slice]:
    """Write ``rows`` as the ``touched`` buckets (None: as all), commit those that
    differ from ``slices``, and return the target's buckets."""
    spark = rows.sparkSession
    folder = versions.new_folder(target, version)
    versions.write_folders(rows, bucket, folder)
    new = {s.slice: s for s in versions.written(spark, folder, rows.schema)}
    after = {n: s for n, s in slices.items() if touched is not None and n not in touched}
    for name, s in new.items():
        old = slices.get(name)
        after[name] = old if old and (old.row_count, old.digest) == (s.row_count, s.digest) else s
    if after == slices and version:
        versions.remove(spark, folder)
    else:
        versions.commit(spark, target, version, list(after.values()))
    return after
