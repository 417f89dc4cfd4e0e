"""Golden product rows through CSV ingestion, silver cleaning and the gold
product dimension.

Fixed values: the CSV rows below are copied verbatim from the source system's
product and category extracts (a handful of rows covering every rule), so the
expected results are the source system's own."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from martlet.operators import gold, silver
from martlet.sources.files import read_csv

PRODUCTS_CSV = """prd_id,prd_key,prd_nm,prd_cost,prd_line,prd_start_dt,prd_end_dt
210,CO-RF-FR-R92B-58,HL Road Frame - Black- 58,,R ,2003-07-01,
212,AC-HE-HL-U509-R,Sport-100 Helmet- Red,12,S ,2011-07-01,2007-12-28
213,AC-HE-HL-U509-R,Sport-100 Helmet- Red,14,S ,2012-07-01,2008-12-27
214,AC-HE-HL-U509-R,Sport-100 Helmet- Red,13,S ,2013-07-01,
331,BI-RB-BK-R50R-52,Road-650 Red- 52,487,R ,2012-07-01,2008-12-27
391,CO-FO-FK-1639,LL Fork,66,,2012-07-01,2008-12-27
542,CO-PE-PD-M282,LL Mountain Pedal,18,M ,2013-07-01,
"""

CATEGORIES_CSV = """ID,CAT,SUBCAT,MAINTENANCE
CO_RF,Components,Road Frames,Yes
AC_HE,Accessories,Helmets,Yes
BI_RB,Bikes,Road Bikes,Yes
CO_FO,Components,Forks,Yes
CO_PD,Components,Pedals,Yes
"""


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("csv")
    (d / "products.csv").write_text(PRODUCTS_CSV)
    (d / "categories.csv").write_text(CATEGORIES_CSV)
    prd = read_csv(spark, str(d / "products.csv"), "crm_prd_info")
    cat = read_csv(spark, str(d / "categories.csv"), "erm_product_category")
    return prd, cat


def test_csv_is_positional_and_typed(sources):
    prd, cat = sources
    assert cat.columns == ["id", "category", "subcategory", "maintenance"]
    rows = {r.prd_id: r for r in prd.collect()}
    assert rows[210].prd_cost is None and rows[210].prd_end_dt is None
    assert rows[212].prd_cost == Decimal("12.00")
    assert rows[391].prd_line is None
    assert rows[214].prd_start_dt == dt.date(2013, 7, 1)


def test_silver_products(sources):
    prd, _ = sources
    s = {r.prd_id: r for r in silver.clean_prd_info(prd, keep_source_end=True).collect()}
    r = s[210]
    assert (r.cat_id, r.prd_key, r.prd_cost, r.prd_line, r.prd_end_dt) == (
        "CO_RF", "FR-R92B-58", Decimal("0.00"), "Road", None
    )
    assert [s[i].prd_end_dt for i in (212, 213, 214)] == [dt.date(2012, 6, 30), dt.date(2013, 6, 30), None]
    assert s[331].prd_end_dt is None and s[331].src_prd_end_dt == dt.date(2008, 12, 27)
    assert s[391].prd_line == "n/a"
    assert s[542].cat_id == "CO_PE"


def test_gold_product_dimension(sources):
    prd, cat = sources
    dim = gold.dim_products(silver.clean_prd_info(prd), silver.clean_product_category(cat))
    rows = sorted(dim.collect(), key=lambda r: r.product_key)
    # one active version per key, numbered 1..n in prd_id order
    assert [r.product_key for r in rows] == [1, 2, 3, 4, 5]
    assert [r.product_id for r in rows] == ["FR-R92B-58", "HL-U509-R", "BK-R50R-52", "FK-1639", "PD-M282"]
    by_id = {r.product_id: r for r in rows}
    assert by_id["FR-R92B-58"].category == "Components"
    assert by_id["PD-M282"].category is None  # CO_PE has no category row (the file has CO_PD)


def test_failfast_on_malformed_rows(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text("prd_id,prd_key,prd_nm,prd_cost,prd_line,prd_start_dt,prd_end_dt\nx,k,n,1,R,2003-07-01,\n")
    with pytest.raises(Exception):
        read_csv(spark, str(p), "crm_prd_info").collect()
