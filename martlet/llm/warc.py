"""WARC archives with an index first: write, choose from the index, read ranges.

``write_archives`` writes one WARC file per task and returns its index: file,
offset, length, URL and digest of every record. Of records with equal payloads
of at least ``min_revisit_bytes`` the one with the largest ``page_id`` is the
response and the others are revisits, which hold no payload. ``read_records``
takes any selection of the index, deals it by file and offset, and reads
neighbouring byte ranges in one request up to ``max_read`` bytes.

The files go through pyarrow's file systems to a folder all executors share. A
retried task writes a file of its own name; the index, written by Spark's
committer, names only the files of tasks that ended, so it alone says what
exists.

Defined cases: a null page is an empty payload; a null URL is written as an
empty target; a null ``page_id`` is never the response of a group that has
another; rows that repeat the response's ``page_id`` and payload are responses
too; an empty table writes no archive. Payloads are written whole; a reading
task holds one coalesced range, or one longer record. Other columns are not
read.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import staged

INDEX = (
    "file string, offset long, length long, url string, digest string, record_type string, page_id long"
)
RECORDS = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
    "payload_digest string, payload binary"
)
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Archive bytes that one reading task is meant to take.
TASK_BYTES = 64 << 20
#: Records of pages fetched at an unknown time carry this date, so that equal input gives equal archives.
NO_DATE = "1970-01-01T00:00:00Z"


def file_system(path: str):  # noqa: ANN201
    """pyarrow's file system of a path, and the path within it."""
    from pyarrow import fs

    if "://" not in path:
        path = path.removeprefix("file:")
    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


def record(page_id: int | None, url: str, payload: bytes, digest: str, size: int, keep: int | None) -> bytes:
    """One record, compressed as a member of its own. ``keep`` names the page
    that a revisit refers to."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http if keep is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if keep is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{record_id(page_id, digest)}>",
        f"WARC-Date: {NO_DATE}",
        f"WARC-Target-URI: {' '.join(url.split())}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Page-Id: {'' if page_id is None else page_id}",
    ]
    if keep is not None:
        head += [
            f"WARC-Profile: {REVISIT_PROFILE}",
            f"WARC-Refers-To: <urn:uuid:{record_id(keep, digest)}>",
            f"X-Refers-To-Page-Id: {keep}",
        ]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()


def record_id(page_id: int | None, digest: str) -> uuid.UUID:
    return uuid.uuid5(uuid.NAMESPACE_URL, f"page:{page_id}:{digest}")


def parse(raw: bytes) -> tuple:
    """A record's bytes to a row of ``RECORDS``; a revisit has no payload of its own."""
    data = zlib.decompress(raw, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    page = int(fields["X-Page-Id"]) if fields["X-Page-Id"].strip() else None
    if fields["WARC-Type"] == "revisit":
        return page, fields["WARC-Target-URI"], "revisit", int(fields["X-Refers-To-Page-Id"]), size, digest, None
    if len(payload) != size or hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"record of page {page} does not match its digest")
    return page, fields["WARC-Target-URI"], "response", None, size, digest, payload


def classified(pages: DataFrame, min_revisit_bytes: int = 1_000) -> DataFrame:
    """page_id, url, payload (none for revisits), digest, size, keep.

    Copies are counted by digest on narrow rows; only digests that occur more
    than once meet the pages again, so payloads without copies need no match.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.encode(F.col("html").cast("string"), "UTF-8"), F.lit(b"")).alias("payload"),
    )
    rows = rows.select("*", F.sha1("payload").alias("digest"), F.octet_length("payload").cast("long").alias("size"))
    copies = staged(
        rows.where(F.col("size") >= min_revisit_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("newest"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and newest is not null")
        .select("digest", "newest"),
        "warc-copies",
    )
    joined = rows.join(copies, "digest", "left")
    keep = F.when(~F.col("newest").eqNullSafe(F.col("page_id")), F.col("newest"))
    joined = joined.withColumn("keep", keep)
    payload = F.when(F.col("keep").isNull(), F.col("payload"))
    return joined.select("page_id", "url", payload.alias("payload"), "digest", "size", "keep")


def write_archives(pages: DataFrame, path: str, min_revisit_bytes: int = 1_000) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as ``path``/*.warc.gz and return
    the staged index of the records."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in INDEX.split(", ")]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()]
        out = file = None
        offset = 0
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                if out is None:
                    from pyspark import TaskContext

                    fs, folder = file_system(path)
                    fs.create_dir(folder, recursive=True)
                    file = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
                    out = fs.open_output_stream(f"{folder}/{file}", compression=None)
                rows = []
                columns = [batch.column(i) for i in range(batch.num_columns)]
                for page_id, url, payload, digest, size, keep in zip(*columns):
                    page_id, url, digest, size, keep = (x.as_py() for x in (page_id, url, digest, size, keep))
                    raw = record(page_id, url, payload.as_py() or b"", digest, size, keep)
                    out.write(raw)
                    kind = "response" if keep is None else "revisit"
                    rows.append((file, offset, len(raw), url, digest, kind, page_id))
                    offset += len(raw)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
        finally:
            if out is not None:
                out.close()

    index = classified(pages, min_revisit_bytes).mapInArrow(write, INDEX)
    return staged(index, "warc-index")


def coalesce_ranges(
    ranges: list[tuple[str, int, int]], max_gap: int, max_read: int
) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """Sorted (file, offset, length) joined into (file, start, end, its
    ranges) wherever the gap is small and the whole stays below ``max_read``."""
    held: list[tuple[int, int]] = []
    name, start, end = "", 0, 0
    for file, offset, length in ranges:
        joins = held and file == name and offset - end <= max_gap and offset + length - start <= max_read
        if held and not joins:
            yield name, start, end, held
            held = []
        if not held:
            name, start, end = file, offset, offset
        held.append((offset, length))
        end = max(end, offset + length)
    if held:
        yield name, start, end, held


def read_records(
    index: DataFrame, path: str, max_gap: int = 64 << 10, max_read: int = 8 << 20
) -> DataFrame:
    """The records that the rows of ``index`` (file, offset, length) name."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = file_system(path)
        names = [f.split()[0] for f in RECORDS.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        open_name, source = None, None
        for batch in batches:
            ranges = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
            for file, start, end, parts in coalesce_ranges(ranges, max_gap, max_read):
                if file != open_name:
                    if source is not None:
                        source.close()
                    open_name, source = file, fs.open_input_file(f"{folder}/{file}")
                data = memoryview(source.read_at(end - start, start))
                rows = [parse(data[o - start : o - start + n]) for o, n in parts]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
        if source is not None:
            source.close()

    chosen = index.select("file", "offset", "length")
    # tasks by the bytes they will read: the index rows themselves are small
    total = chosen.agg(F.sum("length")).first()[0] or 0
    tasks = max(index.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    dealt = chosen.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    return dealt.mapInArrow(read, RECORDS)


#: What writing and reading back gives for every page.
ORACLE_SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
  SELECT page_id, octet_length(payload) AS n, sha1(payload) AS digest FROM p
), k AS (SELECT digest, max(page_id) AS newest FROM d WHERE n >= 1000 GROUP BY digest)
SELECT d.page_id, d.n AS payload_bytes, d.digest AS payload_digest,
       CASE WHEN k.newest IS NULL OR k.newest = d.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN k.newest <> d.page_id THEN k.newest END AS refers_to
FROM d LEFT JOIN k ON d.digest = k.digest AND d.n >= 1000
"""
