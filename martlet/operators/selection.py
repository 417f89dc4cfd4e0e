"""Exact tiles of a whole table without ordering it.

``NTILE(b) OVER (ORDER BY value, key)`` needs only the b - 1 rows at which one tile
ends. Each of these rows is found by counting: a histogram of the range that holds
it (partial counts, merged), then one of the bin that holds it, until the bin is one
value; rows with that value are told apart by their keys in the same way. All cuts of
all rankings share each pass, and a tile is then a comparison of the row with the cut
rows, so nothing is sorted, numbered, joined or shuffled but the counts.

Passes over the table: one for the bounds, then about log(range) / log(bins) for the
values and as many for the keys; the driver receives at most ``bins`` counts a cut and
pass, however large the table.

Defined cases: values are integers or decimals, keys are integers that are not null and
differ from row to row (rows that share value and key get the same tile, and other
rows' tiles are then approximate); a null value is the smallest, so it comes first in
ascending and last in descending rankings; equal values are ranked by ascending key;
with fewer rows than tiles the last tiles stay empty; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BINS = 1024


@dataclass(frozen=True)
class Ranking:
    """Rank by ``value``; the tile goes into column ``out``."""

    value: str
    out: str
    descending: bool = False


@dataclass
class _Cut:
    """The row at position ``rank`` (1-based) among the rows that are left: those
    with a value in low..high or, once the value is ``found``, those with that
    ``value`` and a key in low..high. No key: all rows with the value are before it."""

    ranking: int
    rank: int
    low: int | None
    high: int | None
    found: bool = False
    value: int | None = None
    key: int | None = None
    done: bool = False

    def probe(self) -> tuple:
        return self.ranking, self.found, self.value, self.low, self.high


class _Scaled:
    """A column as an ordered integer: unscaled decimals, negated if descending."""

    def __init__(self, df: DataFrame, name: str, descending: bool = False):
        kind = df.schema[name].dataType
        if isinstance(kind, T.IntegralType):
            kind = T.DecimalType(20, 0)
        elif not isinstance(kind, T.DecimalType):
            raise TypeError(f"{name}: integers and decimals can be ranked, not {kind.simpleString()}")
        self.kind = kind
        column = F.col(name).cast(kind)
        self.column: Column = -column if descending else column

    def unscaled(self, value: Decimal | None) -> int | None:
        return None if value is None else int(Fraction(value) * 10**self.kind.scale)

    def literal(self, unscaled: int) -> Column:
        return F.lit(Decimal(f"{unscaled}E-{self.kind.scale}")).cast(self.kind)

    def bin(self, low: int, step: int) -> Column:
        """Whole number of steps above ``low``, exact at any precision."""
        offset = self.column - self.literal(low)
        return F.call_function("div", offset, self.literal(step))


def with_tiles(df: DataFrame, key: str, rankings: list[Ranking], buckets: int, bins: int = BINS) -> DataFrame:
    """``df`` with a BIGINT tile 1..``buckets`` for every ranking. ``df`` is read once
    a pass: pass a staged table."""
    values = [_Scaled(df, r.value, r.descending) for r in rankings]
    keys = _Scaled(df, key)
    cuts = _cut_rows(df, rankings, values, keys, buckets, bins)
    tiles = []
    for i, ranking in enumerate(rankings):
        tile = F.lit(1).cast("long")
        for cut in cuts:
            if cut.ranking == i:
                tile = tile + _is_after(cut, ranking, values[i], keys).cast("long")
        tiles.append(tile.alias(ranking.out))
    return df.select("*", *tiles)


def _is_after(cut: _Cut, ranking: Ranking, value: _Scaled, keys: _Scaled) -> Column:
    missing = value.column.isNull()
    if cut.value is None:
        same, later = missing, F.lit(False) if ranking.descending else ~missing
    else:
        at = value.literal(cut.value)
        same = F.coalesce(value.column == at, F.lit(False))
        later = F.coalesce(value.column > at, F.lit(ranking.descending))
    return later if cut.key is None else later | (same & (keys.column > keys.literal(cut.key)))


def _cut_rows(
    df: DataFrame, rankings: list[Ranking], values: list[_Scaled], keys: _Scaled, buckets: int, bins: int
) -> list[_Cut]:
    bounds = [F.count(F.lit(1)).alias("n"), F.min(keys.column).alias("key_low"), F.max(keys.column).alias("key_high")]
    for i, v in enumerate(values):
        bounds += [F.count(v.column).alias(f"n{i}"), F.min(v.column).alias(f"low{i}"), F.max(v.column).alias(f"high{i}")]
    seen = df.agg(*bounds).first()
    key_low, key_high = keys.unscaled(seen.key_low), keys.unscaled(seen.key_high)
    quotient, rest = divmod(seen.n, buckets)
    cuts = []
    for i, (ranking, v) in enumerate(zip(rankings, values)):
        present = seen[f"n{i}"]
        before = 0 if ranking.descending else seen.n - present  # nulls ahead of the values
        for tile in range(1, buckets):
            rank = tile * quotient + min(tile, rest)
            if rank >= seen.n:
                break  # no row follows
            if before < rank <= before + present:
                low, high = v.unscaled(seen[f"low{i}"]), v.unscaled(seen[f"high{i}"])
                cuts.append(_Cut(i, rank - before, low, high))
            else:
                nulls = _Cut(i, rank if rank <= before else rank - present, key_low, key_high, found=True)
                nulls.done = nulls.rank == seen.n - present
                cuts.append(nulls)
    while open_cuts := [c for c in cuts if not c.done]:
        probes = sorted({c.probe() for c in open_cuts}, key=str)
        counts = _histograms(df, probes, values, keys, bins)
        for cut in open_cuts:
            _narrow(cut, counts[probes.index(cut.probe())], bins, (key_low, key_high))
    return cuts


def _step(low: int, high: int, bins: int) -> int:
    return -(-(high - low + 1) // bins)


def _histograms(
    df: DataFrame, probes: list[tuple], values: list[_Scaled], keys: _Scaled, bins: int
) -> list[dict[int, int]]:
    """Rows in each bin of each probe."""
    entries = []
    for at, (ranking, found, value, low, high) in enumerate(probes):
        by = keys if found else values[ranking]
        inside = by.column.between(by.literal(low), by.literal(high))
        if found:
            v = values[ranking]
            inside = inside & (v.column.isNull() if value is None else v.column == v.literal(value))
        entry = F.struct(F.lit(at).alias("probe"), by.bin(low, _step(low, high, bins)).alias("bin"))
        entries.append(F.when(inside, entry))
    rows = df.select(F.inline(F.filter(F.array(*entries), lambda e: e.isNotNull())))
    counts: list[dict[int, int]] = [{} for _ in probes]
    for row in rows.groupBy("probe", "bin").count().collect():  # at most ``bins`` rows a probe
        counts[row.probe][row.bin] = row["count"]
    return counts


def _narrow(cut: _Cut, counts: dict[int, int], bins: int, key_range: tuple[int, int]) -> None:
    """Move ``cut`` into the bin that holds its row."""
    step = _step(cut.low, cut.high, bins)
    for at in sorted(counts):
        if cut.rank <= counts[at]:
            break
        cut.rank -= counts[at]
    cut.low += at * step
    cut.high = min(cut.high, cut.low + step - 1)
    if cut.low < cut.high:
        return
    if cut.found:
        cut.key, cut.done = cut.low, True
    else:
        cut.found, cut.value = True, cut.low
        cut.done = cut.rank == counts[at]
        cut.low, cut.high = key_range
