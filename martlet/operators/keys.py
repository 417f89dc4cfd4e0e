"""Surrogate keys that survive reloads.

A registry maps natural keys to dense numbers and only grows: a known key keeps its
number for good, whatever comes or goes, and keys not seen before are numbered after
the largest, in their order, or by the least value of another column that they come
with (``near``), so that keys of one day, say, have numbers close together. It is a versioned table (``sources.versions``) of which
every load with new keys adds one slice, so a load reads the registry once, writes
new keys only, and a killed load leaves no half-registered key.

Numbering is the dense one of ``windows.global_row_number`` over the narrow new keys;
the join back to the rows is a plain one, broadcast by size only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.operators.windows import global_row_number
from martlet.sources import versions


def register(rows: DataFrame, key: str, root: str, out: str, near: str | None = None) -> DataFrame:
    """Number the keys of ``rows`` that the registry at ``root`` does not hold, in
    order of ``near`` (nulls first) if given, then key; returns the registry
    (``key``, ``out``). Null keys are not registered."""
    spark = rows.sparkSession
    schema = T.StructType([T.StructField(key, rows.schema[key].dataType), T.StructField(out, T.LongType())])
    version, slices = versions.manifest(spark, root)
    known = versions.read_slices(spark, list(slices.values()), schema)
    rows = rows.where(F.col(key).isNotNull())
    new = rows.groupBy(key).agg(F.min(near).alias("_near")) if near else rows.select(key).distinct()
    if slices:
        new = new.join(known, key, "left_anti")
    largest = sum(s.row_count for s in slices.values())
    order = [F.asc("_near"), F.asc(key)] if near else [F.asc(key)]
    numbered = global_row_number(new, order, "_n").select(key, (F.col("_n") + largest).alias(out))
    load = versions.Load(spark, root)
    load.tables = dict(slices)
    name = f"keys-{load.version}"
    load.write(name, numbered)
    if load.tables[name].row_count == 0 and slices:
        versions.remove(spark, load.folder)
        return known
    load.commit()
    return versions.read_slices(spark, list(load.tables.values()), schema)


def registered(rows: DataFrame, key: str, root: str, out: str, near: str | None = None) -> DataFrame:
    """``rows`` with their surrogate key ``out``; null keys have none."""
    return rows.join(register(rows, key, root, out, near), key, "left")
