"""Exact distinct counts that can be merged: bitmaps of integer ids.

A state is one bitmap for each group, counted column and bucket of 32,768
consecutive ids. States of different loads or days are merged by OR, so a count over
any period comes from stored states and reads no line again; ids seen in several
states count once. Distinct ids meet as narrow rows before a bitmap is made of them, so
no task makes a bitmap for its share of a group; states are merged by partial
aggregates. A bitmap takes 4 kB however few of its bits are set: ids should be dense
(``operators.keys`` numbers text keys densely), and those of one group close together.

Defined cases: a null id counts nowhere, a null group is a group of its own, negative
ids are ids like others, an empty table has no states, and a group without ids for a
column has a count of 0 if it has one for another column (it is absent otherwise).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATE = ["counted", "bucket", "bitmap"]


def states(rows: DataFrame, by: list[str], ids: list[str]) -> DataFrame:
    """``by``, counted, bucket, bitmap: the distinct ``ids`` columns of ``rows``."""
    entries = F.array(*[F.struct(F.lit(c).alias("counted"), F.col(c).cast("long").alias("id")) for c in ids])
    one = rows.select(*by, F.inline(entries)).where(F.col("id").isNotNull()).distinct()
    group = [*by, "counted", "bucket"]
    # at most 32,768 rows a group are left, and the aggregate needs no other exchange
    placed = one.withColumn("bucket", F.bitmap_bucket_number("id")).repartition(*group)
    return placed.groupBy(*group).agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bitmap"))


def merged(parts: DataFrame, by: list[Column]) -> DataFrame:
    """States of coarser groups ``by``, or of several loads, as one state each."""
    return parts.groupBy(*by, "counted", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def counts(parts: DataFrame, by: list[Column], ids: list[str]) -> DataFrame:
    """``by`` and the distinct count of each of ``ids`` from stored states."""
    total = merged(parts, by)
    names = [c for c in total.columns if c not in STATE]
    bits = F.bitmap_count("bitmap")
    return total.groupBy(*names).agg(
        *[F.coalesce(F.sum(F.when(F.col("counted") == c, bits)), F.lit(0)).cast("long").alias(c) for c in ids]
    )
