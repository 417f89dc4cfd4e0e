"""Streaming ingest of the event table: event-time watermark, de-duplication
of replayed events within the watermark, tumbling daily counts per event type.

The stream runs in update mode; each micro-batch's changed windows are written to a
Parquet folder of the batch through ``foreachBatch``, and the final table keeps, per
window and type, the row of the latest batch. Rows later than the watermark are
dropped by the state store, whose size stays bounded by the watermark;
``streaming.arrivals`` keeps them aside instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from martlet.session import work_path


def daily_counts_stream(events: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """Streaming (or batch) plan: NTZ timestamps are cast to session-zone
    timestamps first, since watermarks need ``timestamp``."""
    ev = events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    return (
        ev.withWatermark("ts", watermark)
        .dropDuplicatesWithinWatermark(["event_id"])
        .groupBy(F.window("ts", "1 day"), "event_type")
        .agg(F.count(F.lit(1)).alias("events"))
    )


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether a path of any file system Spark reads is a folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory()


def run_daily_counts(
    spark: SparkSession,
    source_dir: str,
    file_glob: str = "events.parquet",
    schema: T.StructType | None = None,
    watermark: str = "1 hour",
    max_files_per_trigger: int | None = None,
    state_partitions: int | None = None,
) -> DataFrame:
    """Process everything available (``availableNow``) and return the final
    daily counts as a batch DataFrame (day, event_type, events).

    ``file_glob`` names a table folder of part files, a single file, or a
    pattern of files in ``source_dir``. All files there are one micro-batch, so
    that no row is late, however the table is written. With
    ``max_files_per_trigger`` at most so many files make one; files must then
    arrive in event-time order to within the watermark from one micro-batch to the
    next. State is kept on disk (RocksDB) in ``state_partitions`` partitions
    (default: the cluster's core count). Both settings are made in a session of
    the query's own."""
    folder = f"{source_dir.rstrip('/')}/{file_glob}"
    whole_table = "*" not in file_glob and is_folder(spark, folder)
    if schema is None:
        schema = spark.read.parquet(folder).schema
    own = state_session(spark, state_partitions)
    reader = own.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    events = reader.parquet(folder) if whole_table else reader.option("pathGlobFilter", file_glob).parquet(source_dir)
    counts = daily_counts_stream(events, watermark)

    out = work_path(spark, "daily-counts")
    query = write_batches(counts, out, work_path(spark, "daily-counts-state")).trigger(availableNow=True).start()
    query.awaitTermination()
    return final_counts(spark, out, counts.schema)


def state_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session of a stream's own: state on disk (RocksDB), in so many partitions
    (default: the cluster's core count)."""
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", str(state_partitions or spark.sparkContext.defaultParallelism))
    own.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    # a batch writes what it changed, not the whole state
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return own


def _batched(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("_batch", T.LongType())])


def write_batches(counts: DataFrame, out: str, checkpoint: str) -> DataStreamWriter:
    """The stream's changed windows, each micro-batch in a folder of its own under
    ``out``, so that a batch that is run again replaces its rows."""
    # the answer exists, empty, before the first micro-batch: a read error later is an error
    spark = counts.sparkSession
    spark.createDataFrame([], _batched(counts.schema)).write.mode("overwrite").parquet(f"{out}/none")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("_batch", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(f"{out}/{batch_id}")

    return counts.writeStream.outputMode("update").foreachBatch(write_batch).option("checkpointLocation", checkpoint)


def final_counts(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """Of every window and type the row of the latest batch."""
    latest = (
        spark.read.schema(_batched(schema))
        .option("recursiveFileLookup", "true")
        .parquet(out)
        .groupBy("window", "event_type")
        .agg(F.max_by("events", "_batch").alias("events"))
    )
    return latest.select(
        F.col("window.start").cast("date").alias("day"), "event_type", F.col("events").cast("long").alias("events")
    )
