"""Bind the driver's TPC-H-style tables to the six bronze source tables.

The mart's sources are a CRM extract (customers, product versions, sales lines)
and an ERP extract (customer demographics, customer locations, product
categories). This module derives each of them from the given tables with
deterministic column expressions, so every bronze row comes from a real row
and the work grows with the data:

* ``crm_cust_info``        <- customer, some with an older second row or a row without id
* ``erm_customers``        <- customer (ids partly ``NAS``-prefixed, free-form gender)
* ``erm_customer_location``<- customer join nation (ids with a dash, country codes)
* ``crm_prd_info``         <- part; parts sharing (name, type, brand) are versions
                              of one product, ordered by a start date
* ``erm_product_category`` <- distinct (type, brand) of part
* ``crm_sales_details``    <- lineitem left join orders left join part (one row per line)

Dirty values the cleaning layer must repair (bad date codes, negative, zero or
missing money; repeated and missing customer ids, locations and categories
that match nothing, lines of unknown customers and products) are injected by
fixed rules on the row keys, listed below. All other lines satisfy
sales = quantity * price.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.schemas import BRONZE, COST, MONEY
from martlet.sources.files import read_parquet

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
)

# ---- fixed binding rules (our own choices, shared with the SQL oracle) -------
CUSTOMER_KEY_PREFIX = "AW"
ORDER_NUMBER_PREFIX = "SO"
CREATE_DATE_BASE = "1994-01-01"  # crm create date = base + (custkey % 1000) days
BIRTH_DATE_BASE = "1940-01-01"  # birth date = base + (custkey * 7919 % 23000) days
PRODUCT_START_BASE = "1992-01-01"  # start date = base + (partkey * 37 % 3000) days
MARITAL_BY_KEY = ["M", "S", "M ", "s", None, "S"]  # index custkey % 6
ERP_GENDER_BY_KEY = ["M", " f ", "Female", "male", None]  # index custkey % 5
COUNTRY_BY_NATION = {0: "US", 1: "USA", 2: "DE", 3: "  ", 4: None, 5: "n/a"}  # else ' ' || n_name
LINE_BY_SIZE = ["R ", "M ", "S ", "T ", None]  # index p_size % 5
MAINTENANCE_TYPES = ["LARGE", "MEDIUM"]  # category maintenance 'Yes' for these types
BAD_ORDER_DATE_ZERO = 97  # o_orderkey % 97 = 0  -> order date '0'
BAD_ORDER_DATE_SHORT = 101  # o_orderkey % 101 = 0 -> order date '5489'
DUE_DAYS = 30  # due date = order date + 30 days
# damage selector d = (l_orderkey * 7 + l_linenumber) % 100:
#   0 sales negated, 1 sales NULL, 2 sales 0, 3 price NULL, 4 price negated,
#   5 price 0, 6 sales and price NULL, 7 ship date '0'
OLDER_ROW = (50, 7)  # custkey % 50 = 7 -> a second row, created 100 days earlier
NO_ID_ROW = (100, 13)  # custkey % 100 = 13 -> a second row without id
STRAY_LOCATION = (40, 11)  # custkey % 40 = 11 -> the location's id has another prefix
STRAY_LOCATION_PREFIX = "AX"
STRAY_CATEGORY_BRAND = "Brand#13"  # its categories carry another id
UNKNOWN_CUSTOMER = (211, 5)  # orderkey % 211 = 5 -> a customer id below zero
UNKNOWN_PRODUCT = (223, 9)  # orderkey % 223 = 9 -> a product key with a prefix
UNKNOWN_PRODUCT_PREFIX = "XX-"
# -----------------------------------------------------------------------------


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(index: Column, values: list) -> Column:
    out = None
    for i, v in enumerate(values):
        lit = F.lit(v).cast("string")
        out = F.when(index == i, lit) if out is None else out.when(index == i, lit)
    return out


def _hits(key: Column, rule: tuple[int, int]) -> Column:
    """The row's key is one of every ``rule[0]``."""
    return F.pmod(key, F.lit(rule[0])) == rule[1]


def _days_after(base: str, days: Column) -> Column:
    return F.date_add(F.lit(base).cast("date"), days.cast("int"))


def customer_key(custkey: Column) -> Column:
    return F.concat(F.lit(CUSTOMER_KEY_PREFIX), custkey.cast("string"))


def bronze_crm_cust_info(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    # 0 the customer's row, 1 an older row, 2 a row without id
    rows = F.array_compact(
        F.array(
            F.lit(0),
            F.when(_hits(k, OLDER_ROW), F.lit(1)),
            F.when(_hits(k, NO_ID_ROW), F.lit(2)),
        )
    )
    customer = customer.select("*", F.explode(rows).alias("_row"))
    row = F.col("_row")
    out = customer.select(
        F.when(row != 2, k).alias("cst_id"),
        customer_key(k).alias("cst_key"),
        F.concat(F.lit(" "), F.substring_index("c_name", "#", 1), F.lit(" ")).alias("cst_firstname"),
        F.substring_index("c_name", "#", -1).alias("cst_lastname"),
        _pick(k % 6, MARITAL_BY_KEY).alias("cst_marital_status"),
        F.substring("c_mktsegment", 1, 1).alias("cst_gndr"),
        _days_after(CREATE_DATE_BASE, k % 1000 - F.when(row == 1, 100).otherwise(0)).alias("cst_create_date"),
    )
    return _conform(out, "crm_cust_info")


def bronze_erm_customers(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    key = customer_key(k)
    out = customer.select(
        F.when(k % 4 == 0, F.concat(F.lit("NAS"), key)).otherwise(key).alias("cid"),
        _days_after(BIRTH_DATE_BASE, (k * 7919) % 23000).alias("birth_date"),
        _pick(k % 5, ERP_GENDER_BY_KEY).alias("gender"),
    )
    return _conform(out, "erm_customers")


def bronze_erm_customer_location(customer: DataFrame, nation: DataFrame) -> DataFrame:
    # nation is the fixed 25-row TPC-H nation list; Catalyst broadcasts it by
    # its file size, and would fall back to a shuffle join if it ever grew.
    n = F.col("n_nationkey")
    country = None
    for key, code in COUNTRY_BY_NATION.items():
        lit = F.lit(code).cast("string")
        country = F.when(n == key, lit) if country is None else country.when(n == key, lit)
    country = country.otherwise(F.concat(F.lit(" "), F.col("n_name")))
    out = customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left").select(
        F.concat(
            F.when(_hits(F.col("c_custkey"), STRAY_LOCATION), STRAY_LOCATION_PREFIX).otherwise(CUSTOMER_KEY_PREFIX),
            F.lit("-"),
            F.col("c_custkey").cast("string"),
        ).alias("cid"),
        country.alias("country"),
    )
    return _conform(out, "erm_customer_location")


def category_code() -> Column:
    """Five-character category code of a part, e.g. ``ST-07`` (type ST..., Brand#7)."""
    brand = F.lpad(F.substring_index("p_brand", "#", -1), 2, "0")
    return F.concat(F.upper(F.substring("p_type", 1, 2)), F.lit("-"), brand)


def product_code() -> Column:
    """Product key as sales refer to it: name, type and brand, e.g. ``SMALL-RING-ST-07``."""
    return F.concat(F.replace(F.upper("p_name"), F.lit(" "), F.lit("-")), F.lit("-"), category_code())


def bronze_crm_prd_info(part: DataFrame) -> DataFrame:
    start = _days_after(PRODUCT_START_BASE, (F.col("p_partkey") * 37) % 3000)
    size = F.col("p_size")
    out = part.select(
        F.col("p_partkey").alias("prd_id"),
        F.concat(category_code(), F.lit("-"), product_code()).alias("prd_key"),
        F.col("p_name").alias("prd_nm"),
        F.when(size == 1, F.lit(None)).otherwise(F.col("p_retailprice").cast(COST)).alias("prd_cost"),
        _pick(size % 5, LINE_BY_SIZE).alias("prd_line"),
        start.alias("prd_start_dt"),
        F.when(size % 3 == 0, F.date_sub(start, (size * 10).cast("int"))).alias("prd_end_dt"),
    )
    return _conform(out, "crm_prd_info")


def bronze_erm_product_category(part: DataFrame) -> DataFrame:
    cats = part.select(
        F.concat(
            F.replace(category_code(), F.lit("-"), F.lit("_")),
            F.when(F.col("p_brand") == STRAY_CATEGORY_BRAND, "?").otherwise(""),
        ).alias("id"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        F.when(F.col("p_type").isin(*MAINTENANCE_TYPES), "Yes").otherwise("No").alias("maintenance"),
    ).distinct()
    return _conform(cats, "erm_product_category")


def _yyyymmdd(c: Column) -> Column:
    """Date as ``yyyyMMdd`` text, built arithmetically (cheaper than a formatter)."""
    code = F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)
    return F.lpad(code.cast("string"), 8, "0")


def bronze_crm_sales_details(lineitem: DataFrame, orders: DataFrame, part: DataFrame) -> DataFrame:
    li = lineitem.select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    od = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    pt = part.select("p_partkey", product_code().alias("_prd_code"))
    # left joins: a line without its order or part stays, as a line of nothing known
    rows = li.join(od, li.l_orderkey == od.o_orderkey, "left").join(pt, li.l_partkey == pt.p_partkey, "left")

    okey = F.col("l_orderkey")
    qty = F.col("l_quantity").cast("int")
    price = (F.col("l_extendedprice").cast(MONEY) / F.nullif(qty, F.lit(0))).cast(MONEY)
    null_money = F.lit(None).cast(MONEY)
    # what several columns use is worked out once, in projections short enough for the JIT compiler
    rows = rows.select(
        "l_orderkey",
        "o_custkey",
        "_prd_code",
        F.col("o_orderdate").cast("date").alias("_ordered"),
        F.col("l_shipdate").cast("date").alias("_shipped"),
        qty.alias("_qty"),
        price.alias("_price"),
        ((okey * 7 + F.col("l_linenumber")) % 100).alias("_damage"),
    )
    rows = rows.select("*", (F.col("_qty") * F.col("_price")).cast(MONEY).alias("_sales"))
    d, price, sales, order_date = (F.col(c) for c in ("_damage", "_price", "_sales", "_ordered"))

    out = rows.select(
        F.concat(F.lit(ORDER_NUMBER_PREFIX), okey.cast("string")).alias("sls_ord_num"),
        F.when(_hits(okey, UNKNOWN_PRODUCT), F.concat(F.lit(UNKNOWN_PRODUCT_PREFIX), "_prd_code"))
        .otherwise(F.col("_prd_code"))
        .alias("sls_prd_key"),
        F.when(_hits(okey, UNKNOWN_CUSTOMER), -1 - F.col("o_custkey")).otherwise(F.col("o_custkey")).alias("sls_cust_id"),
        F.when(okey % BAD_ORDER_DATE_ZERO == 0, "0")
        .when(okey % BAD_ORDER_DATE_SHORT == 0, "5489")
        .otherwise(_yyyymmdd(order_date))
        .alias("sls_order_dt"),
        F.when(d == 7, "0").otherwise(_yyyymmdd(F.col("_shipped"))).alias("sls_ship_dt"),
        _yyyymmdd(F.date_add(order_date, DUE_DAYS)).alias("sls_due_dt"),
        F.when(d == 0, -sales)
        .when(d.isin(1, 6), null_money)
        .when(d == 2, F.lit(0).cast(MONEY))
        .otherwise(sales)
        .alias("sls_sales"),
        F.col("_qty").alias("sls_quantity"),
        F.when(d.isin(3, 6), null_money)
        .when(d == 4, -price)
        .when(d == 5, F.lit(0).cast(MONEY))
        .otherwise(price)
        .alias("sls_price"),
    )
    return _conform(out, "crm_sales_details")


def write_delivered_sales(sales: DataFrame, path: str) -> None:
    """The bronze sales rows as the plain comma-separated lines of another writer
    (NULL an empty field), some of them damaged on a rule of the customer id: cut
    after the fifth field, a field too many, a quantity or both amounts in words."""
    damage = F.coalesce(F.abs("sls_cust_id") % 40, F.lit(-1))
    fields = []
    for name in sales.columns:
        field = F.coalesce(F.col(name).cast("string"), F.lit(""))
        if name == "sls_quantity":
            field = F.when(damage == 2, F.lit("many")).otherwise(field)
        if name in ("sls_sales", "sls_price"):
            field = F.when(damage == 3, F.lit("free")).otherwise(field)
        fields.append(field)
    line = (
        F.when(damage == 0, F.concat_ws(",", *fields[:5]))
        .when(damage == 1, F.concat_ws(",", *fields, F.lit("?")))
        .otherwise(F.concat_ws(",", *fields))
    )
    header = ",".join(sales.columns)
    sales.select(line.alias(header)).write.option("header", True).option("sep", "\u0001").option("quote", "").csv(path)


def _conform(df: DataFrame, table: str) -> DataFrame:
    """Typed projection onto the declared bronze schema (positional)."""
    schema = BRONZE[table]
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


class LazyTables(dict):
    """Mapping of table name -> DataFrame that builds each table on first use."""

    def __init__(self, builders):
        super().__init__()
        self._builders = dict(builders)

    def __missing__(self, name: str) -> DataFrame:
        df = self._builders[name]()
        self[name] = df
        return df

    def names(self) -> list[str]:
        return list(self._builders)


def bronze_tables(spark: SparkSession, sf_dir: str, table=None) -> LazyTables:
    """All six bronze tables over the given testdata folder, each built lazily.
    ``table(name)`` supplies source scans (default: one memoised scan each)."""

    scans: dict[str, DataFrame] = {}

    def t(name: str) -> DataFrame:
        if table is not None:
            return table(name)
        # one scan definition per source table, shared by every bronze table
        if name not in scans:
            scans[name] = read_table(spark, sf_dir, name)
        return scans[name]

    return LazyTables(
        {
            "crm_cust_info": lambda: bronze_crm_cust_info(t("customer")),
            "crm_prd_info": lambda: bronze_crm_prd_info(t("part")),
            "crm_sales_details": lambda: bronze_crm_sales_details(t("lineitem"), t("orders"), t("part")),
            "erm_customers": lambda: bronze_erm_customers(t("customer")),
            "erm_customer_location": lambda: bronze_erm_customer_location(t("customer"), t("nation")),
            "erm_product_category": lambda: bronze_erm_product_category(t("part")),
        }
    )
