"""Sales and price repair (both rules read the raw, unrepaired columns)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martlet.schemas import MONEY


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def repaired_sales(sales: str | Column, qty: str | Column, price: str | Column) -> Column:
    """NULL, non-positive or inconsistent sales are rebuilt as ``|qty| * |price|``.

    If the price is NULL the consistency test is NULL, so positive sales are
    kept; bad sales with a NULL price stay NULL.
    """
    s, q, p = _col(sales), _col(qty), _col(price)
    rebuilt = F.abs(q) * F.abs(p)
    bad = s.isNull() | (s <= 0) | (s != rebuilt)
    return F.when(bad, rebuilt).otherwise(s).cast(MONEY)


def repaired_price(sales: str | Column, qty: str | Column, price: str | Column) -> Column:
    """NULL or non-positive prices become ``|sales| / NULLIF(qty, 0)``, else ``|price|``.

    The quantity is not made absolute (a negative quantity gives a negative
    price) and the result is rounded half-up to the column's two decimals.
    """
    s, q, p = _col(sales), _col(qty), _col(price)
    bad = p.isNull() | (p <= 0)
    return F.when(bad, F.abs(s) / F.nullif(q, F.lit(0))).otherwise(F.abs(p)).cast(MONEY)
