"""SimHash near-duplicates through a segment-popcount embedding.

A fingerprint is mapped to the bit counts of its 2-bit segments, packed in
place. The Manhattan distance of two such vectors never exceeds the Hamming
distance of the fingerprints, so a grid join on them loses no link: the
segments are dealt into groups, at least one of which must lie within its
share of the allowed distance (0 or 1), and each group is a grid cell that a
fingerprint enters with its own counts and, where the share is 1, with each
count raised by one. Pairs that meet in a cell are verified on all 64 bits.

Equal fingerprints are one node, so copies are never paired with each other;
links between different fingerprints become components by star contraction.

Defined cases: a null text is empty; texts without words get fingerprint 0 and
link like any other; fewer words than a shingle are one shingle; rows sharing a
``doc_id`` are kept; a null ``doc_id`` never names a component unless all its
rows are null; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from martlet.llm.common import connected_components, documents, quoted, staged

SEED = 42
SEGMENTS = 32
#: Shingles whose bits are counted at a time, to bound memory for long texts.
COUNT_ROWS = 1 << 16


def fingerprint(text: str, shingle: int = 4) -> int:
    """Unsigned 64-bit SimHash of the lower-cased word shingles of a text."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, n)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts[: n - k + 1].tolist(), ends[k - 1 :].tolist())),
        np.uint64,
        n - k + 1,
    )
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), COUNT_ROWS):
        rows = hashes[at : at + COUNT_ROWS].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle: int = 4) -> Column:
    """The fingerprint of each text as a signed long."""

    @F.pandas_udf("long")
    def of(texts):  # noqa: ANN001, ANN202
        import pandas as pd

        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    return of(F.coalesce(text.cast("string"), F.lit("")))


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, fp) per row; fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"]
            )

    return documents(docs).mapInArrow(run, "doc_id long, fp long")


def _groups(max_distance: int) -> list[tuple[list[int], int]]:
    """(segments, share) of each group; the shares plus one add up to
    ``max_distance + 1``, so a pair within it meets in some group."""
    shares = [1] * ((max_distance + 1) // 2) + [0] * ((max_distance + 1) % 2)
    # a share of one admits about one more segment's worth of neighbours: such groups are longer
    weight = [23 if s else 18 for s in shares]
    cuts = np.round(np.cumsum([0, *weight]) / sum(weight) * SEGMENTS).astype(int)
    return [(list(range(a, b)), s) for a, b, s in zip(cuts[:-1], cuts[1:], shares)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def popcount_vector(fp: Column) -> Column:
    """Bit counts of the 2-bit segments, two bits each, in place."""
    mask = F.lit(0x5555555555555555).cast("long")
    low, high = fp.bitwiseAND(mask), F.shiftrightunsigned(fp, 1).bitwiseAND(mask)
    return low.bitwiseXOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def linked_fingerprints(fps: DataFrame, max_distance: int = 4) -> DataFrame:
    """(u, v), u < v, for every two different fingerprints of column ``fp``
    (distinct) that differ in at most ``max_distance`` bits."""
    if not 1 <= max_distance <= 20:
        raise ValueError("max_distance must be between 1 and 20")
    cells = []
    for g, (segments, share) in enumerate(_groups(max_distance)):
        mask = F.lit(_signed(sum(3 << (2 * s) for s in segments))).cast("long")
        key = F.col("vector").bitwiseAND(mask)
        count = {s: F.shiftrightunsigned("vector", 2 * s).bitwiseAND(F.lit(3)) for s in segments}
        raised = [  # 0 -> 1, 1 -> 2, none for 2
            F.when(count[s] == 0, key.bitwiseXOR(F.lit(_signed(1 << 2 * s)).cast("long"))).when(
                count[s] == 1, key.bitwiseXOR(F.lit(_signed(3 << 2 * s)).cast("long"))
            )
            for s in segments
        ]
        cells.append(F.struct(F.lit(g).alias("g"), key.alias("key"), F.lit(True).alias("own")))
        cells += [
            F.struct(F.lit(g).alias("g"), k.alias("key"), F.lit(False).alias("own")) for k in raised if share
        ]
    grid = (
        fps.select("fp", popcount_vector(F.col("fp")).alias("vector"))
        .select("fp", F.explode(F.array(*cells)).alias("c"))
        .select("fp", "c.g", "c.key", "c.own")
        .where("key is not null")
    )
    own = grid.where("own").select(F.col("fp").alias("a"), "g", "key")
    other = grid.select(F.col("fp").alias("b"), "g", "key", "own")
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance
    # two own entries meet in both orders, an own and a raised one only in this order
    once = (F.col("a") != F.col("b")) & (~F.col("own") | (F.col("a") < F.col("b")))
    pairs = own.join(
        other, (own["g"] == other["g"]) & (own["key"] == other["key"]) & once & close, "inner"
    )
    return pairs.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct()


def fingerprint_classes(fps: DataFrame, max_distance: int = 4) -> DataFrame:
    """(fp, root) for the distinct values of ``fps.fp`` that link to another."""
    links = linked_fingerprints(fps.select("fp").distinct(), max_distance)
    return connected_components(links).select(F.col("node").alias("fp"), "root")


def near_duplicates(docs: DataFrame, shingle: int = 4, max_distance: int = 4) -> DataFrame:
    """One row per document: doc_id, fp and component_id, the smallest
    ``doc_id`` reachable over links of at most ``max_distance`` bits."""
    rows = staged(fingerprints(docs, shingle), "simhash")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    classes = fingerprint_classes(rows, max_distance)
    nodes = nodes.join(classes, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = nodes.join(ids, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, max_distance: int = 4) -> DataFrame:
    """``docs`` with one row of each class left: the smallest ``doc_id``, equal
    ones by the hash of the whole row. Columns stay as they are."""
    columns = [quoted(c) for c in docs.columns]
    tagged = staged(
        docs.select(
            F.struct(*columns).alias("row"),
            F.col("doc_id").alias("doc_id"),
            fingerprint_column(F.col("text"), shingle).alias("fp"),
            F.xxhash64(*[c.cast("string") for c in columns]).alias("tie"),
        ),
        "simhash",
    )
    classes = fingerprint_classes(tagged, max_distance)
    first = W.partitionBy("class").orderBy(F.col("doc_id").asc_nulls_last(), "tie")
    return (
        tagged.join(classes, "fp", "left")
        .withColumn("class", F.coalesce("root", "fp"))
        .withColumn("rank", F.row_number().over(first))
        .where("rank = 1")
        .select("row.*")
    )
