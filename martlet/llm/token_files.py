"""Token-id files: Parquet list columns in ascending document order.

``write_token_files`` encodes whole texts and writes one row per document in
ascending ``doc_id``: ids as a dictionary-encoded list column, the counters as
delta-encoded integers, in row groups and pages of stated size with Parquet's
page index. A reader that wants a range of documents, or only the counters,
touches only those pages and columns (``read_token_files``).

Defined cases: a null text is empty and yields the end id alone; a null
``doc_id`` sorts first; rows that share a ``doc_id`` are kept, ordered by text;
an empty table writes no rows. Texts of any length are encoded whole; one text
and one output batch of about ``BATCH_BYTES`` are in memory at a time. Other
columns of the input are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from martlet.llm import tokens
from martlet.llm.common import documents

BATCH_BYTES = 8 << 20
FILE_SCHEMA = "doc_id long, part int, first long, n_tokens int, token_ids array<int>"


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 1,
    row_group_bytes: int = 16 << 20,
    page_bytes: int = 64 << 10,
    page_rows: int = 2_000,
) -> None:
    """Encode ``docs`` (doc_id, text) into Parquet files under ``path``.

    Files are range partitions of ``doc_id``; ``first`` counts the ids before
    the document within its file ``part``, so the ids before it in the whole
    table follow from one total per file (``token_starts``).
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, first = TaskContext.get().partitionId(), 0
        ids_of = tokens.encoder(tokenizer, end_id)
        rows: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            ids = [r[3] for r in rows]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([part] * len(rows), pa.int32()),
                    pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([r[2] for r in rows], pa.int32()),
                    tokens.id_lists(ids),
                ],
                names=["doc_id", "part", "first", "n_tokens", "token_ids"],
            )

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = ids_of(text.as_py())
                rows.append((doc_id, first, len(ids) // 4, ids))
                first += len(ids) // 4
                size += len(ids)
                if size >= BATCH_BYTES:
                    yield flush()
                    rows, size = [], 0
        if rows:
            yield flush()

    order = [F.col("doc_id").asc_nulls_first(), F.col("tie"), F.col("text")]
    ordered = (
        documents(docs)
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(*order[:2])
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
    )
    (
        ordered.mapInArrow(encode, FILE_SCHEMA)
        .write.option("compression", "zstd")
        .option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.enable.dictionary", "false")
        .option("parquet.enable.dictionary#token_ids.list.element", "true")
        .option("parquet.block.size", row_group_bytes)
        .option("parquet.page.size", page_bytes)
        .option("parquet.page.row.count.limit", page_rows)
        .parquet(path)
    )


def read_token_files(
    spark: SparkSession, path: str, first_doc: int | None = None, last_doc: int | None = None
) -> DataFrame:
    """The written rows, by a ``doc_id`` range if one is given (both ends
    included); the range is pushed down to row groups and pages."""
    rows = spark.read.schema(FILE_SCHEMA).parquet(path)
    if first_doc is not None:
        rows = rows.where(F.col("doc_id") >= first_doc)
    if last_doc is not None:
        rows = rows.where(F.col("doc_id") <= last_doc)
    return rows


def token_starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, base): ids in all files before each file; one row per file, read
    from the counter columns alone."""
    totals = read_token_files(spark, path).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = tokens.id_bytes(batch.column(3))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    batch.column(2),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                ],
                names=["doc_id", "part", "first", "n_tokens", "ids_crc32"],
            )

    rows = (
        read_token_files(spark, path)
        .select("doc_id", "part", "first", "token_ids")
        .mapInArrow(digest, "doc_id long, part int, first long, n_tokens long, ids_crc32 long")
    )
    # one row per written file: a broadcast bounded by the number of files
    return rows.join(F.broadcast(token_starts(spark, path)), "part").select(
        "doc_id", (F.col("first") + F.col("base")).alias("start"), "n_tokens", "ids_crc32"
    )
