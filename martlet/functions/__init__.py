"""Column expressions (JVM-side built-ins only; no Python UDFs)."""

from martlet.functions.codes import (  # noqa: F401
    category_id,
    country_fallback,
    crm_gender,
    erp_gender,
    gender_priority,
    marital_status,
    product_key,
    product_line,
    remove_dashes,
    standardise_country,
    strip_customer_prefix,
    strip_whitespace,
)
from martlet.functions.dates import (  # noqa: F401
    age_month_part,
    age_months,
    decode_yyyymmdd,
    decode_yyyymmdd_guarded,
    whole_years,
)
from martlet.functions.money import repaired_price, repaired_sales  # noqa: F401
