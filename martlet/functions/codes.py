"""Code maps and key normalisers of the cleaning layer.

Fixed values that must equal the reference's for identical results are kept
together below, as plain text in their natural order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must match the reference) --------------------------------
MARITAL_CODES = {"M": "Married", "S": "Single"}
CRM_GENDER_CODES = {"M": "Male", "F": "Female"}
ERP_GENDER_CODES = {"M": "Male", "F": "Female", "MALE": "Male", "FEMALE": "Female"}
PRODUCT_LINE_CODES = {"R": "Road", "M": "Mountain", "S": "Sport", "T": "Touring"}
COUNTRY_CODES = {"USA": "United States", "US": "United States", "DE": "Germany"}
NOT_AVAILABLE = "n/a"
UNKNOWN_COUNTRY = "unknown"
CUSTOMER_ID_PREFIX = "NAS"
# ------------------------------------------------------------------------------


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def map_codes(c: str | Column, mapping: dict[str, str], default: str = NOT_AVAILABLE) -> Column:
    """Exact-match code lookup as a CASE chain; unmatched and NULL give ``default``."""
    c = _col(c)
    out = None
    for code, label in mapping.items():
        out = (F.when(c == code, label) if out is None else out.when(c == code, label))
    return out.otherwise(default)


def marital_status(c: str | Column) -> Column:
    """Strict: only ``'M'``/``'S'`` exactly; no trimming or case folding."""
    return map_codes(c, MARITAL_CODES)


def crm_gender(c: str | Column) -> Column:
    """Strict: only ``'M'``/``'F'`` exactly."""
    return map_codes(c, CRM_GENDER_CODES)


def erp_gender(c: str | Column) -> Column:
    """Tolerant: ``UPPER(TRIM(x))`` in M / F / MALE / FEMALE."""
    return map_codes(F.upper(F.trim(_col(c))), ERP_GENDER_CODES)


def product_line(c: str | Column) -> Column:
    """``TRIM(x)`` in R / M / S / T, else n/a."""
    return map_codes(F.trim(_col(c)), PRODUCT_LINE_CODES)


def category_id(prd_key: str | Column) -> Column:
    """First five characters of the product key with ``-`` replaced by ``_``."""
    return F.replace(F.substring(_col(prd_key), 1, 5), F.lit("-"), F.lit("_"))


def product_key(prd_key: str | Column) -> Column:
    """Product key from the seventh character on."""
    return F.substr(_col(prd_key), F.lit(7))


def strip_customer_prefix(cid: str | Column) -> Column:
    """Drop a leading ``NAS`` from ERP customer ids."""
    cid = _col(cid)
    return F.when(cid.startswith(CUSTOMER_ID_PREFIX), F.substr(cid, F.lit(len(CUSTOMER_ID_PREFIX) + 1))).otherwise(cid)


def remove_dashes(cid: str | Column) -> Column:
    return F.replace(_col(cid), F.lit("-"), F.lit(""))


def standardise_country(c: str | Column) -> Column:
    """USA/US -> United States, DE -> Germany, NULL/blank -> unknown, else trimmed."""
    c = _col(c)
    t = F.trim(c)
    out = None
    for code, name in COUNTRY_CODES.items():
        out = F.when(t == code, name) if out is None else out.when(t == code, name)
    return out.when(c.isNull() | (t == ""), UNKNOWN_COUNTRY).otherwise(t)


def country_fallback(c: str | Column) -> Column:
    """Gold rule: NULL, blank or ``n/a`` -> unknown, else trimmed."""
    c = _col(c)
    t = F.trim(c)
    return F.when(c.isNull() | (t == "") | (t == NOT_AVAILABLE), UNKNOWN_COUNTRY).otherwise(t)


def gender_priority(crm: str | Column, erp: str | Column) -> Column:
    """CRM gender unless it is ``n/a`` (or NULL), else the ERP gender, else n/a."""
    crm, erp = _col(crm), _col(erp)
    return F.when(crm != NOT_AVAILABLE, crm).otherwise(F.coalesce(erp, F.lit(NOT_AVAILABLE)))


def strip_whitespace(c: str | Column) -> Column:
    """Remove all leading/trailing whitespace (tabs, newlines too), not just spaces."""
    return F.regexp_replace(_col(c), r"^\s+|\s+$", "")
