"""Unit tables for the column rules of the cleaning layer."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from martlet.functions import codes, dates, money

D = dt.date


def _eval(spark, rows, schema, *cols):
    return spark.createDataFrame(rows, schema).select(*cols).collect()


def test_age_months_at_month_ends(spark):
    rows = [
        (D(2013, 2, 28), D(2013, 1, 31)),
        (D(2013, 3, 1), D(2013, 1, 31)),
        (D(2014, 3, 1), D(2012, 1, 31)),
        (D(2013, 1, 31), D(2013, 3, 1)),
        (D(2012, 2, 29), D(2011, 2, 28)),
        (None, D(2013, 1, 1)),
    ]
    got = _eval(
        spark,
        rows,
        "a date, b date",
        dates.age_months("a", "b").alias("m"),
        dates.age_month_part("a", "b").alias("p"),
        dates.whole_years("a", "b").alias("y"),
    )
    assert [r.m for r in got] == [0, 1, 25, -1, 12, None]
    assert [r.p for r in got] == [0, 1, 1, -1, 0, None]
    assert [r.y for r in got] == [0, 0, 2, 0, 1, None]


def test_decode_dates(spark):
    values = ["20131229", "0", "-1", "5489", "abc", "20131345", "20130231", None, "20120229"]
    got = _eval(
        spark,
        [(v,) for v in values],
        "s string",
        dates.decode_yyyymmdd_guarded("s").alias("g"),
        dates.decode_yyyymmdd("s").alias("u"),
    )
    expected = [D(2013, 12, 29), None, None, None, None, None, None, None, D(2012, 2, 29)]
    assert [r.g for r in got] == expected
    assert [r.u for r in got] == expected


def test_sales_and_price_repair_worked_rows(spark):
    # raw sales, qty, raw price -> sales, price
    table = [
        ("-10.00", 1, "10.00", "10.00", "10.00"),
        (None, 2, "5.00", "10.00", "5.00"),
        ("30.00", 2, None, "30.00", "15.00"),
        ("20.00", 2, "0.00", "0.00", "10.00"),
        ("10.00", 2, "-10.00", "20.00", "5.00"),
        ("10.00", -2, None, "10.00", "-5.00"),
        ("10.00", 0, None, "10.00", None),
        (None, 2, None, None, None),
        ("10.01", 2, None, "10.01", "5.01"),
    ]
    dec = lambda v: None if v is None else Decimal(v)
    rows = [(dec(s), q, dec(p)) for s, q, p, _, _ in table]
    got = _eval(
        spark,
        rows,
        "s decimal(12,2), q int, p decimal(12,2)",
        money.repaired_sales("s", "q", "p").alias("s2"),
        money.repaired_price("s", "q", "p").alias("p2"),
    )
    assert [r.s2 for r in got] == [dec(e) for *_, e, _ in table]
    assert [r.p2 for r in got] == [dec(e) for *_, e in table]


def test_code_maps(spark):
    values = ["M", "S", "F", "M ", "m", None, " f ", "Female", "male", "x"]
    got = _eval(
        spark,
        [(v,) for v in values],
        "c string",
        codes.marital_status("c").alias("ms"),
        codes.crm_gender("c").alias("cg"),
        codes.erp_gender("c").alias("eg"),
    )
    assert [r.ms for r in got] == ["Married", "Single", "n/a", "n/a", "n/a", "n/a", "n/a", "n/a", "n/a", "n/a"]
    assert [r.cg for r in got] == ["Male", "n/a", "Female", "n/a", "n/a", "n/a", "n/a", "n/a", "n/a", "n/a"]
    assert [r.eg for r in got] == ["Male", "n/a", "Female", "Male", "Male", "n/a", "Female", "Female", "Male", "n/a"]


def test_product_line_and_key_split(spark):
    got = _eval(
        spark,
        [("CO-RF-FR-R92B-58", "R "), ("AC-HE-HL-U509-R", "S "), ("CO-FO-FK-1639", None), ("X", "T")],
        "k string, l string",
        codes.category_id("k").alias("cat"),
        codes.product_key("k").alias("key"),
        codes.product_line("l").alias("line"),
    )
    assert [(r.cat, r.key, r.line) for r in got] == [
        ("CO_RF", "FR-R92B-58", "Road"),
        ("AC_HE", "HL-U509-R", "Sport"),
        ("CO_FO", "FK-1639", "n/a"),
        ("X", "", "Touring"),
    ]


def test_customer_keys_and_countries(spark):
    got = _eval(
        spark,
        [("NASAW00011000", "US"), ("AW-00011000", "USA"), ("AW00011001", " DE"), ("NAS", "  "), (None, None),
         ("AW1", " Canada ")],
        "cid string, country string",
        codes.strip_customer_prefix("cid").alias("a"),
        codes.remove_dashes("cid").alias("b"),
        codes.standardise_country("country").alias("c"),
    )
    assert [r.a for r in got] == ["AW00011000", "AW-00011000", "AW00011001", "", None, "AW1"]
    assert [r.b for r in got] == ["NASAW00011000", "AW00011000", "AW00011001", "NAS", None, "AW1"]
    assert [r.c for r in got] == ["United States", "United States", "Germany", "unknown", "unknown", "Canada"]


def test_gold_country_and_gender_priority(spark):
    got = _eval(
        spark,
        [("n/a", "Male", "n/a"), ("Female", "Male", " Canada "), (None, None, None), ("n/a", None, "")],
        "crm string, erp string, country string",
        codes.gender_priority("crm", "erp").alias("g"),
        codes.country_fallback("country").alias("c"),
    )
    assert [r.g for r in got] == ["Male", "Female", "n/a", "n/a"]
    assert [r.c for r in got] == ["unknown", "Canada", "unknown", "unknown"]


def test_whitespace_strip(spark):
    got = _eval(spark, [(" a\t",), ("\n b c \r",), (None,)], "s string", codes.strip_whitespace("s").alias("s"))
    assert [r.s for r in got] == ["a", "b c", None]
