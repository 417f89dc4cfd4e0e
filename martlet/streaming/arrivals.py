"""Daily counts of events that arrive in several lots, with late rows kept aside.

Each lot is a folder of Parquet files. Before a lot reaches the stream, its rows are
held against the watermark that the lots before it have left (their largest event
time less the delay): rows at or before it, and rows without a time, go to a side
table; the others land, as one folder in one step, and are one micro-batch of the
counting stream. The stream's own watermark is never ahead of that rule, so it drops
nothing, and its state (ids of the last delay, open days) stays bounded by the
watermark. Every event is in the counts, a repeat of a counted event, or aside.

``land_in_ranges`` cuts any table, however its files are ordered, into lots of
consecutive event times, of which nothing is late. ``settled_counts`` adds what lies
aside to the counts.

A run that is stopped goes on where it was: the side rows of a lot are written
before it lands, landed lots are skipped, and the stream has its checkpoint.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.session import work_path
from martlet.streaming.daily_counts import daily_counts_stream, final_counts, state_session, write_batches

#: What the counts read of an event.
EVENT = "event_id long, ts timestamp, event_type string"
SECOND = 1_000_000


@dataclass(frozen=True)
class Lot:
    """What became of one lot: rows landed, rows aside, the watermark in microseconds."""

    name: str
    landed: int
    aside: int
    watermark: int | None


@dataclass(frozen=True)
class Arrivals:
    counts: DataFrame
    aside: DataFrame
    landed: DataFrame
    lots: tuple[Lot, ...]
    batches: int


def _fs(spark: SparkSession, path: str):  # noqa: ANN202
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def land_in_ranges(events: DataFrame, folder: str, ranges: int, tasks: int = 1) -> list[str]:
    """Write ``events`` as ``ranges`` lots of consecutive event times (``tasks``
    files each) and return their folders in order."""
    n = ranges * tasks
    place = F.floor(F.spark_partition_id() / F.lit(tasks)).cast("int")
    rows = events.select(F.col("event_id").cast("long"), F.col("ts").cast("timestamp"), F.col("event_type").cast("string"))
    rows.repartitionByRange(n, F.col("ts").asc_nulls_first()).withColumn("lot", place).write.partitionBy("lot").parquet(folder)
    fs, _ = _fs(events.sparkSession, folder)
    out = []
    for lot in range(ranges):
        _, at = _fs(events.sparkSession, f"{folder}/lot={lot}")
        if fs.exists(at):
            out.append(f"{folder}/lot={lot}")
    return out


def _micros(column: str):  # noqa: ANN202
    return F.unix_micros(F.col(column))


def count_arrivals(
    spark: SparkSession,
    lots: list[str],
    root: str | None = None,
    delay: dt.timedelta = dt.timedelta(hours=1),
    state_partitions: int | None = None,
) -> Arrivals:
    """Send the lots (folders with the columns of ``EVENT``) through the counting
    stream in the given order.

    A lot's folder is taken over: without late rows it is moved into the landed
    table, otherwise its rows are written there and to the side table. ``root``
    holds landed rows, side rows, counts and the stream's state; give it to go on
    with an earlier run, whose lots keep their order."""
    root = root or work_path(spark, "arrivals")
    landed, aside = f"{root}/landed", f"{root}/aside"
    fs, landed_at = _fs(spark, landed)
    fs.mkdirs(landed_at)
    wait = int(delay.total_seconds() * SECOND)

    own = state_session(spark, state_partitions)
    # a lot is one micro-batch; state it makes obsolete goes with the next one
    own.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    events = own.readStream.schema(EVENT).option("recursiveFileLookup", "true").parquet(landed)
    counts = daily_counts_stream(events, f"{int(delay.total_seconds())} seconds")
    query = write_batches(counts, f"{root}/counts", f"{root}/state").start()
    done: list[Lot] = []
    try:
        query.processAllAvailable()  # lots of an earlier run that was stopped
        largest = None
        if fs.listStatus(landed_at):
            largest = spark.read.schema(EVENT).option("recursiveFileLookup", "true").parquet(landed).agg(F.max(_micros("ts"))).first()[0]
        for n, folder in enumerate(lots):
            name = f"lot-{n:06d}"
            _, target = _fs(spark, f"{landed}/{name}")
            if fs.exists(target):
                continue
            # the stream keeps whole milliseconds
            watermark = None if largest is None else largest // 1000 * 1000 - wait
            rows = spark.read.schema(EVENT).parquet(folder)
            late = F.col("ts").isNull() if watermark is None else F.coalesce(_micros("ts") <= F.lit(watermark), F.lit(True))
            size, away, latest = rows.agg(F.count(F.lit(1)), F.count_if(late), F.max(_micros("ts"))).first()
            source = folder
            if away:
                rows.where(late).write.mode("overwrite").parquet(f"{aside}/{name}")
                source = f"{root}/incoming/{name}"
                rows.where(~late).write.mode("overwrite").parquet(source)
            if not fs.rename(_fs(spark, source)[1], target):
                raise RuntimeError(f"{source} could not be moved to {target}")
            query.processAllAvailable()
            done.append(Lot(name, size - away, away, watermark))
            largest = max((x for x in (largest, latest) if x is not None), default=None)
        progress = query.recentProgress
    finally:
        query.stop()
    dropped = sum(s.get("numRowsDroppedByWatermark", 0) for p in progress for s in p["stateOperators"])
    if dropped:
        raise RuntimeError(f"the stream dropped {dropped} rows that had landed in time")
    by_file = spark.read.schema(EVENT).option("recursiveFileLookup", "true")
    fs.mkdirs(_fs(spark, aside)[1])
    return Arrivals(
        final_counts(spark, f"{root}/counts", counts.schema),
        by_file.parquet(aside),
        by_file.parquet(landed),
        tuple(done),
        sum(p["numInputRows"] > 0 for p in progress),
    )


def settled_counts(arrivals: Arrivals) -> DataFrame:
    """The counts with the rows that lay aside: each event that was not counted
    yet, once. Rows without a time are counted under no day."""
    if not arrivals.aside.limit(1).count():
        return arrivals.counts
    counted = arrivals.landed.select(F.col("event_id").alias("seen")).distinct()
    first = arrivals.aside.groupBy("event_id").agg(F.min(F.struct(F.col("ts").isNull(), "ts", "event_type")).alias("e"))
    rest = first.join(counted, F.col("event_id").eqNullSafe(F.col("seen")), "left_anti")
    more = rest.groupBy(F.col("e.ts").cast("date").alias("day"), F.col("e.event_type").alias("event_type")).agg(
        F.count(F.lit(1)).alias("events")
    )
    return arrivals.counts.unionByName(more).groupBy("day", "event_type").agg(F.sum("events").alias("events"))


def counts_in_ranges(
    spark: SparkSession, events: DataFrame, ranges: int, delay: dt.timedelta = dt.timedelta(hours=1), state_partitions: int | None = None
) -> DataFrame:
    """Daily counts per event type of a whole table, whatever the order of its
    files, in ``ranges`` micro-batches of consecutive event times."""
    root = work_path(spark, "arrivals")
    lots = land_in_ranges(events, f"{root}/lots", ranges)
    return settled_counts(count_arrivals(spark, lots, f"{root}/run", delay, state_partitions))
