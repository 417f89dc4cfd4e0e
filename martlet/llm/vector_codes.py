"""Product codes of integer vectors, with exact distances from limb-split GEMM.

Every component becomes an integer, ``floor(scale * x)``. Vectors are cut into
``parts`` equal consecutive parts, and each part position has a codebook of
``entries`` integer entries, which starts as that part of the vectors with the
smallest ids and is moved ``rounds`` times to the componentwise floor of the
mean of the parts nearest to each entry. A vector's code is the index of the
nearest entry of every part, the first of equally near ones.

Distances are exact integers. Components and entries are broken into limbs of so
few bits that a float64 matrix product of two limb matrices stays below 2^53 in
every partial sum; the limb products are shifted and added in int64 (in Python
integers where magnitudes do not fit), and the first argmin is taken of
``|entry|^2 - 2 part.entry``.

A round is one pass over the staged integer vectors: each task adds its parts up
by entry and emits ``parts x entries x part length`` sums, Spark adds those, and
the driver sees one row for each codebook component, whatever the table's size.
Codebooks, of the same bounded size, travel to the tasks with the function. Sums
are exact at any size (limbs within a task, decimals between tasks).

Defined cases: rows whose vector is null or holds a null, NaN or infinite
component have no code (a component counts as infinite if ``scale`` times it
leaves the range of a double); vectors of unlike length, or of a length that is no
multiple of ``parts``, count as filled up with zeros to the least such multiple of
the longest; a null id sorts last, rows that share an id sort by vector; fewer
than ``entries`` rows give as many entries; repeated rows are coded each; an
empty table gives no rows. Entries that no part is nearest to stay. Errors beyond
the range of a long are given as its largest value. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.llm.common import quoted, staged

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
LONG_MAX = 2**63 - 1


def limb_bits(length: int) -> int:
    """Bits of a limb such that a dot product of ``length`` limb pairs is below 2^53."""
    return (53 - max(1, length - 1).bit_length()) // 2 if length else 26


def float_limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """Integer-valued float64 numbers as limbs, lowest first: x = sum of limb k * 2^(bits k).
    All but the highest limb are in [0, 2^bits); the highest carries the sign."""
    base = float(2**bits)
    out = []
    while x.size and np.abs(x).max() >= base:
        high = np.floor(x / base)
        out.append(x - high * base)
        x = high
    return [*out, x]


def int_limbs(values: list[int], shape: tuple[int, ...], bits: int) -> list[np.ndarray]:
    """Python integers as limbs, like ``float_limbs``."""
    count = max(1, -(-max((abs(v).bit_length() for v in values), default=0) // bits))
    out = []
    for k in range(count):
        last = k == count - 1
        out.append(np.array([v if last else v & (2**bits - 1) for v in values], dtype=np.float64).reshape(shape))
        values = [v >> bits for v in values]
    return out


def exact_products(a: list[np.ndarray], b: list[np.ndarray], bits: int, wide: bool) -> np.ndarray:
    """a @ b.T of limb-split integer matrices: float64 BLAS products, each exact,
    recombined in int64, or in Python integers if ``wide``."""
    total = None
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            piece = (x @ y.T).astype(np.int64)
            piece = (piece.astype(object) if wide else piece) * (1 << bits * (i + j))
            total = piece if total is None else total + piece
    return total


def exact_squares(a: list[np.ndarray], bits: int, wide: bool) -> np.ndarray:
    """Squared length of every row of a limb-split integer matrix."""
    total = None
    for i, x in enumerate(a):
        for j, y in enumerate(a):
            piece = np.einsum("nd,nd->n", x, y).astype(np.int64)
            piece = (piece.astype(object) if wide else piece) * (1 << bits * (i + j))
            total = piece if total is None else total + piece
    return total


@dataclass(frozen=True)
class Codebooks:
    """entries[part][entry][position]: Python integers."""

    entries: tuple[tuple[tuple[int, ...], ...], ...]

    @property
    def length(self) -> int:
        return len(self.entries[0][0]) if self.entries and self.entries[0] else 0

    def sha256(self) -> str:
        numbers = (str(v) for part in self.entries for entry in part for v in entry)
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First nearest entry and squared distance, both (row, part), of the
        integer-valued rows ``x``."""
        bits, length = limb_bits(self.length), self.length
        codes = np.zeros((len(x), len(self.entries)), np.int64)
        errors = np.zeros(codes.shape, np.int64)
        for p, part in enumerate(self.entries):
            flat = [v for entry in part for v in entry]
            mine = x[:, p * length : (p + 1) * length]
            largest = max([1, *map(abs, flat), int(np.abs(mine).max()) if mine.size else 0])
            # |x|^2, |c|^2 and 2xc: no sum of them may leave 62 bits
            wide = 4 * max(1, length) * largest**2 >= 2**62
            own = float_limbs(np.ascontiguousarray(mine), bits)
            book = int_limbs(flat, (len(part), length), bits)
            distance = exact_squares(book, bits, wide)[None, :] - 2 * exact_products(own, book, bits, wide)
            best = np.argmin(distance, axis=1)
            error = distance[np.arange(len(x)), best] + exact_squares(own, bits, wide)
            codes[:, p] = best
            if wide:
                errors = errors.astype(object)
            errors[:, p] = error
        return codes, errors


def _padded(lists: pa.Array, width: int) -> np.ndarray:
    """A list<double> column as rows of ``width``, short lists filled with zeros."""
    offsets = lists.offsets.to_numpy()
    flat = lists.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    if width and len(sizes) and (sizes == width).all():
        return flat[offsets[0] : offsets[-1]].reshape(-1, width)
    out = np.zeros((len(lists), width))
    for i, (a, n) in enumerate(zip(offsets[:-1], sizes)):
        out[i, :n] = flat[a : a + n]
    return out


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int = SCALE) -> DataFrame:
    """vec_id, label and ``vector``, the integers floor(scale * x) as doubles, of
    the rows whose vector is whole."""
    rows = df.select(quoted(id_col).alias("vec_id"), quoted(label_col).alias("label"), quoted(vector_col).cast("array<double>").alias("vector"))

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.filter(batch.column(2).is_valid())
            lists = whole.column(2)
            # lists that were filtered may keep the values of lists that are gone
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            sizes = np.array(lists.value_lengths(), dtype=np.int64)
            with np.errstate(over="ignore", invalid="ignore"):
                values = np.floor(flat * scale)
            row = np.repeat(np.arange(len(sizes)), sizes)
            bad = np.bincount(row[~np.isfinite(values)], minlength=len(sizes)) > 0  # nulls are NaN by now
            offsets = np.concatenate([[0], np.cumsum(sizes[~bad])]).astype(np.int32)
            kept = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values[~bad[row]] + 0.0))
            whole = whole.filter(pa.array(~bad))
            yield pa.RecordBatch.from_arrays([whole.column(0), whole.column(1), kept], names=["vec_id", "label", "vector"])

    return rows.mapInArrow(scaled, rows.schema)


def _sums(books: Codebooks, width: int, bits: int):  # noqa: ANN202
    """Batches of vectors -> part, entry, position, limb, total, count."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length = books.length
        totals: dict[tuple[int, int, int], np.ndarray] = {}
        counts: dict[tuple[int, int], int] = {}
        for batch in batches:
            x = _padded(batch.column(0), width)
            codes, _ = books.nearest(x)
            for p in range(len(books.entries)):
                limbs = float_limbs(np.ascontiguousarray(x[:, p * length : (p + 1) * length]), bits)
                for e in np.unique(codes[:, p]).tolist():
                    chosen = codes[:, p] == e
                    counts[p, e] = counts.get((p, e), 0) + int(chosen.sum())
                    for k, limb in enumerate(limbs):
                        add = limb[chosen].astype(np.int64).sum(axis=0)
                        totals[p, e, k] = totals[p, e, k] + add if (p, e, k) in totals else add
        rows = [(p, e, d, k, int(v), counts[p, e]) for (p, e, k), sums in totals.items() for d, v in enumerate(sums)]
        names = ["part", "entry", "position", "limb", "total", "members"]
        columns = [pa.array([r[i] for r in rows], pa.int32() if i < 4 else pa.int64()) for i in range(6)]
        yield pa.RecordBatch.from_arrays(columns, names=names)

    return of


def moved(kept: DataFrame, books: Codebooks, width: int) -> Codebooks:
    """The codebooks after one round."""
    bits = limb_bits(books.length)
    schema = "part int, entry int, position int, limb int, total long, members long"
    # one row for each codebook component and limb reaches the driver; limb k of a
    # component is there for every task that had one, its members only count for limb 0
    rows = (
        kept.select("vector")
        .mapInArrow(_sums(books, width, bits), schema)
        .groupBy("part", "entry", "position", "limb")
        .agg(F.sum(F.col("total").cast("decimal(20,0)")).alias("total"), F.sum("members").alias("members"))
        .collect()
    )
    totals: dict[tuple[int, int, int], int] = {}
    members: dict[tuple[int, int], int] = {}
    for r in rows:
        at = (r.part, r.entry, r.position)
        totals[at] = totals.get(at, 0) + (int(r.total) << bits * r.limb)
        if r.limb == 0:
            members[at[:2]] = r.members
    entries = [[list(entry) for entry in part] for part in books.entries]
    for (p, e, d), total in totals.items():
        entries[p][e][d] = total // members[p, e]
    return Codebooks(tuple(tuple(tuple(e) for e in part) for part in entries))


def fit(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[Codebooks, int]:
    """Codebooks learnt from all ``integer_vectors``, and the padded length."""
    longest = kept.agg(F.max(F.size("vector"))).first()[0] or 0
    length = -(-longest // parts)
    first = kept.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).select("vector").collect()
    seeds = [[int(v) for v in r.vector] + [0] * (length * parts - len(r.vector)) for r in first]
    books = Codebooks(tuple(tuple(tuple(s[p * length : (p + 1) * length]) for s in seeds) for p in range(parts)))
    for _ in range(rounds if seeds and length else 0):
        books = moved(kept, books, length * parts)
    return books, length * parts


def coded(kept: DataFrame, books: Codebooks, width: int) -> DataFrame:
    """vec_id, label, code and error of every row."""
    schema = T.StructType([*kept.select("vec_id", "label").schema.fields, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, errors = books.nearest(_padded(batch.column(2), width))
            texts = ["".join(f"{c:02x}" for c in row) for row in codes.tolist()]
            # each part's error may fit where their sum does not
            sums = [min(sum(row), LONG_MAX) for row in errors.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(sums, pa.int64())],
                names=["vec_id", "label", "code", "error"],
            )

    return kept.mapInArrow(of, schema)


def saturated(total: Column) -> Column:
    return F.least(total, F.lit(LONG_MAX).cast("decimal(38,0)")).cast("long")


def compress(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> DataFrame:
    """vec_id, label, code, error, label_error, codebooks_sha256 of every whole vector."""
    if entries > 256 or parts < 1 or entries < 1:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries, at least one part")
    kept = staged(integer_vectors(df, id_col, vector_col, label_col, scale), "integer-vectors")
    books, width = fit(kept, parts, entries, rounds)
    codes = staged(coded(kept, books, width), "vector-codes")
    # staged: its size decides between a broadcast and a shuffled join, which splits a hot label
    by_label = staged(
        codes.groupBy(F.col("label").alias("of")).agg(saturated(F.sum(F.col("error").cast("decimal(19,0)"))).alias("label_error")),
        "label-errors",
    )
    return codes.join(by_label, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "label", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")
    )


def oracle_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same rows in SQL, for vectors of one length that ``parts`` divides."""
    steps = [
        f"""
        kept AS (
          SELECT vec_id, label, [CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
          FROM embeddings
          WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ),
        flat AS (
          SELECT vec_id, label, v, len(v) // {parts} AS n, unnest(range(len(v))) AS i FROM kept
        ),
        comps AS (SELECT vec_id, i // n AS part, i % n AS pos, v[i + 1] AS x FROM flat),
        b0 AS (
          SELECT part, rank - 1 AS entry, pos, x AS c
          FROM comps JOIN (
            SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS rank FROM kept QUALIFY rank <= {entries}
          ) USING (vec_id)
        )"""
    ]
    for r in range(rounds + 1):
        steps.append(
            f"""
        d{r} AS (
          SELECT vec_id, part, entry, CAST(sum((x - c) * (x - c)) AS BIGINT) AS d
          FROM comps JOIN b{r} USING (part, pos) GROUP BY vec_id, part, entry
        ),
        a{r} AS (
          SELECT vec_id, part, entry, d FROM d{r}
          QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY d, entry) = 1
        )"""
        )
        if r < rounds:
            steps.append(
                f"""
        m{r} AS (
          SELECT part, entry, pos, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
          FROM comps JOIN a{r} USING (vec_id, part) GROUP BY part, entry, pos
        ),
        b{r + 1} AS (
          SELECT part, entry, pos, coalesce((s - (((s % n) + n) % n)) // n, c) AS c
          FROM b{r} LEFT JOIN m{r} USING (part, entry, pos)
        )"""
            )
    return f"""
        WITH {",".join(steps)},
        codes AS (
          SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
          FROM a{rounds} GROUP BY vec_id
        ),
        hashed AS (
          SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM b{rounds}
        )
        SELECT vec_id, code, error,
               CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
        FROM codes JOIN kept USING (vec_id), hashed
        """


ORACLE_SQL = oracle_sql()
