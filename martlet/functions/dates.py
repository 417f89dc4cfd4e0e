"""Date expressions: yyyyMMdd decoding and PostgreSQL-style whole-month ages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_PATTERN = "yyyyMMdd"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode_yyyymmdd(c: str | Column) -> Column:
    """Unguarded decode: text ``yyyyMMdd`` to date, anything unparsable to NULL."""
    return F.try_to_date(_col(c).cast("string"), DATE_PATTERN)


def decode_yyyymmdd_guarded(c: str | Column) -> Column:
    """Guarded decode: values ``<= 0`` or not 8 characters long become NULL first.

    The numeric guard uses ``try_cast`` so text such as ``'abc'`` is simply not
    a number (NULL) instead of failing the job under ANSI casting.
    """
    raw = _col(c).cast("string")
    bad = (raw.try_cast("long") <= 0) | (F.length(raw) != 8)
    return F.when(bad, F.lit(None).cast("date")).otherwise(decode_yyyymmdd(raw))


def _forward_months(a: Column, b: Column) -> Column:
    whole = (F.year(a) - F.year(b)) * 12 + (F.month(a) - F.month(b))
    return whole - F.when(F.dayofmonth(a) < F.dayofmonth(b), 1).otherwise(0)


def age_months(a: str | Column, b: str | Column) -> Column:
    """Complete months of ``AGE(a, b)``: years * 12 + months of the interval.

    A month only counts once the day of month is reached, so 2013-01-31 to
    2013-02-28 is 0 months. For ``a < b`` the result is the negated age of the
    swapped pair. NULL in, NULL out. Returned as BIGINT.
    """
    a, b = _col(a), _col(b)
    return (
        F.when(a >= b, _forward_months(a, b))
        .when(a < b, -_forward_months(b, a))
        .cast("long")
    )


def age_month_part(a: str | Column, b: str | Column) -> Column:
    """``DATE_PART('month', AGE(a, b))``: the month field of the age, -11..11."""
    return (age_months(a, b) % 12).cast("long")


def whole_years(a: str | Column, b: str | Column) -> Column:
    """Complete years of ``AGE(a, b)`` (e.g. age in years at ``a`` of a birth date ``b``)."""
    total = age_months(a, b)
    return ((total - total % 12) / 12).cast("long")
