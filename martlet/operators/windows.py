"""Window-shaped operators written to survive hot keys and huge inputs.

* ``latest_per_key`` -- keep one row per key (``ROW_NUMBER() ... = 1``). Spark
  plans it with a partial ``WindowGroupLimit`` before the shuffle, so a key
  holding a third of all rows is cut to one row per map task before it moves.
* ``lead_within_key`` -- ``LEAD(v) OVER (PARTITION BY k ORDER BY o)``. A plain
  window sends every row of a key to one task; here the rows are first
  range-partitioned on (k, o) and staged once, so a hot key is spread over
  several ordered chunks, the lead is taken inside each chunk, and the last
  row of a chunk takes the first value of the key's next chunk.
* ``global_row_number`` -- ``ROW_NUMBER() OVER (ORDER BY o)`` without funnelling
  all rows into one partition: range-partition and sort, stage the result (so
  both passes see the same partitions), count rows per partition, turn the counts
  into offsets over a table with one row per partition, add local positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from martlet.session import stage_table


def _by_range(df: DataFrame, n: int | None, *cols) -> DataFrame:
    """Range-partition on ``cols``. Without an explicit ``n`` the count comes
    from ``spark.sql.shuffle.partitions`` and AQE may coalesce adjacent ranges
    toward the advisory partition size (coalesced ranges stay in order), so
    small inputs do not become hundreds of tiny partitions and large ones keep
    partitions of a bounded size."""
    return df.repartitionByRange(n, *cols) if n else df.repartitionByRange(*cols)


def latest_per_key(
    df: DataFrame,
    key: str,
    order: list[Column],
    drop_null_keys: bool = True,
) -> DataFrame:
    """One row per ``key``: the first under ``order`` (give NULL placement and a
    unique tie-break explicitly, e.g. ``[F.desc_nulls_first(d), F.desc(id)]``)."""
    if drop_null_keys:
        df = df.where(F.col(key).isNotNull())
    w = W.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def lead_within_key(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    value: str,
    out: str,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``out`` = the next row's ``value`` within ``keys`` under ``order``.

    ``order`` must be a total order inside a key (end it with a unique column).
    """
    # Range bounds come from sampling and are not guaranteed to repeat between
    # two executions, so the sorted rows, tagged with chunk and position, are
    # written once (a staged table in the shared checkpoint folder) and both
    # uses below read that table.
    in_order = [*[F.col(k).asc_nulls_first() for k in keys], *order]
    ranged = stage_table(
        _by_range(df, num_partitions, *in_order)
        .sortWithinPartitions(*in_order)
        .withColumn("_chunk", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id()),
        "lead-chunks",
    )
    w_chunk = W.partitionBy(*keys, "_chunk").orderBy("_pos")
    local = ranged.withColumn("_lead", F.lead(value).over(w_chunk)).withColumn(
        "_last", F.lead(F.lit(True)).over(w_chunk).isNull()
    )
    # first value of every (key, chunk): a partial aggregate, and at most as many
    # rows for a hot key as there are range partitions
    firsts = ranged.groupBy(*keys, "_chunk").agg(F.min_by(F.struct(value), "_pos").alias("_first"))
    following = firsts.select(
        *[F.col(k).alias(f"_next_{i}") for i, k in enumerate(keys)],
        F.col("_chunk").alias("_next_chunk"),
        F.lead(F.col("_first")[value]).over(W.partitionBy(*keys).orderBy("_chunk")).alias("_next_first"),
    )
    same = F.col("_chunk") == F.col("_next_chunk")
    for i, k in enumerate(keys):
        same = same & local[k].eqNullSafe(F.col(f"_next_{i}"))
    result = local.join(following, same, "left").withColumn(
        out, F.when(F.col("_last"), F.col("_next_first")).otherwise(F.col("_lead"))
    )
    return result.select(*df.columns, out)


def global_row_number(
    df: DataFrame,
    order: list[Column],
    out: str,
    num_partitions: int | None = None,
    total: str | None = None,
) -> DataFrame:
    """Add ``out`` = ``ROW_NUMBER() OVER (ORDER BY order)`` as BIGINT 1..n
    (and, if ``total`` is given, the row count n as that column).

    ``order`` must be unique for the numbering to be deterministic. The sorted
    frame, tagged with partition index and position, is written once to the
    shared checkpoint folder, so the counting pass and the numbering pass read
    identical data even if executors are lost in between.
    """
    ranged = (
        _by_range(df, num_partitions, *order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    ranged = stage_table(ranged, "row-number")
    # monotonically_increasing_id = (partition index << 33) + position in partition
    local = ranged.withColumn("_pos", F.col("_mid") - F.shiftleft(F.col("_part").cast("long"), 33))
    counts = local.groupBy("_part").agg(F.count(F.lit(1)).alias("_cnt"))
    # one row per partition: a bounded table, so the un-partitioned window and
    # the broadcast below are safe at any data size
    offsets = counts.select(
        "_part",
        F.coalesce(
            F.sum("_cnt").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
        ).alias("_offset"),
        F.sum("_cnt").over(W.partitionBy()).alias("_total"),
    )
    numbered = local.join(F.broadcast(offsets), "_part").withColumn(
        out, (F.col("_offset") + F.col("_pos") + 1).cast("long")
    )
    if total:
        numbered = numbered.withColumn(total, F.col("_total").cast("long"))
    numbered = numbered.drop("_part", "_mid", "_pos", "_offset", "_total")
    return numbered


def ntile_from_row_number(rn: Column, total: Column, buckets: int) -> Column:
    """``NTILE(buckets)`` from a 1-based row number and the row count.

    Matches the SQL definition: with ``total = q * buckets + r`` the first ``r``
    tiles hold ``q + 1`` rows and the rest ``q``.
    """
    q = F.floor(total / buckets).cast("long")
    r = (total - q * buckets).cast("long")
    big = r * (q + 1)
    return (
        F.when(rn <= big, F.floor((rn - 1) / (q + 1)) + 1)
        .otherwise(F.floor((rn - big - 1) / F.greatest(q, F.lit(1))) + r + 1)
        .cast("long")
    )
