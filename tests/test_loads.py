"""Loads switch as a whole, keep their row counts, and change no known key."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from martlet.operators import keys
from martlet.plans import catalog, load, quality
from martlet.plans.warehouse import Warehouse
from martlet.session import work_path
from martlet.sources import sinks, versions
from tests.conftest import SF_SMALL


class Delivery(Warehouse):
    """The test warehouse with fewer rows of the customer extract."""

    def __init__(self, spark, customers):
        super().__init__(spark, SF_SMALL)
        full = Warehouse(spark, SF_SMALL).bronze
        self.bronze = {n: full[n].where(customers) if n == "crm_cust_info" else full[n] for n in load.BRONZE}


def run(wh, root, **more):
    return load.load_warehouse(wh, catalog.PRODUCT_SEGMENTS, catalog.CUSTOMER_SEGMENTS, root, **more)


def keys_of(spark, table, key, surrogate):
    return {r[0]: r[1] for r in spark.table(table).select(key, surrogate).collect()}


@pytest.fixture(scope="module")
def root(spark):
    """A warehouse whose first load lacked a quarter of the customers."""
    root = work_path(spark, "loads")
    run(Delivery(spark, "cst_id % 4 <> 1"), root)
    return root


def test_a_killed_load_leaves_the_old_warehouse(spark, root, monkeypatch):
    before = {t: spark.table(t).count() for t in ("silver.crm_cust_info", "gold.dim_customers", "gold.fact_sales")}
    keys_before = keys_of(spark, "gold.dim_customers", "customer_key", "customer_id")
    version = versions.newest_version(spark, root)

    def killed(*args, **kwargs):
        raise OSError("killed between silver and gold")

    monkeypatch.setattr(load.advanced, "product_report", killed)
    with pytest.raises(OSError):
        run(Warehouse(spark, SF_SMALL), root)
    assert versions.newest_version(spark, root) == version
    assert {t: spark.table(t).count() for t in before} == before
    assert keys_of(spark, "gold.dim_customers", "customer_key", "customer_id") == keys_before
    old = load.committed(spark, root, Warehouse(spark, SF_SMALL).as_of)
    assert old.stored("gold.dim_customers").count() == before["gold.dim_customers"]


def test_reload_keeps_keys_and_a_late_switch_is_made_up(spark, root, monkeypatch):
    before = keys_of(spark, "gold.dim_customers", "customer_key", "customer_id")
    monkeypatch.setattr(load, "repoint", lambda *a: (_ for _ in ()).throw(OSError("killed after the commit")))
    with pytest.raises(OSError):
        run(Warehouse(spark, SF_SMALL), root)
    # the catalogue still shows the old load, the record the new one
    assert keys_of(spark, "gold.dim_customers", "customer_key", "customer_id") == before
    monkeypatch.undo()
    assert load.repoint(spark, root)["gold.fact_sales"] == "view"
    after = keys_of(spark, "gold.dim_customers", "customer_key", "customer_id")
    assert set(before) <= set(after) and all(after[k] == n for k, n in before.items())
    assert sorted(after.values()) == list(range(1, len(after) + 1))
    fact, want = spark.table("gold.fact_sales"), Warehouse(spark, SF_SMALL).fact()
    assert fact.count() == want.count()
    assert fact.select("product_key").exceptAll(want.select("product_key")).count() == 0
    for name in ("silver.crm_cust_info", "gold.rpt_customer_report"):
        assert spark.table(name).where("dwh_create_date is null").count() == 0


def test_lost_rows_refuse_a_load(spark, root):
    version = versions.newest_version(spark, root)
    lossy = Delivery(spark, "cst_id % 2 = 0")
    with pytest.raises(versions.RowCountVariance, match="bronze.crm_cust_info"):
        run(lossy, root, max_variance=0.2)
    assert versions.newest_version(spark, root) == version
    run(lossy, root, max_variance=0.9)
    rows = {r.table_name: r for r in quality.row_count_variance(spark, root, 0.2).collect()}
    assert not rows["bronze.crm_cust_info"].passed and not rows["gold.dim_customers"].passed
    assert rows["bronze.crm_sales_details"].passed and rows["bronze.crm_sales_details"].variance == 0.0
    # customers that went and come back have the keys they had
    fewer = keys_of(spark, "gold.dim_customers", "customer_key", "customer_id")
    run(Warehouse(spark, SF_SMALL), root)
    again = keys_of(spark, "gold.dim_customers", "customer_key", "customer_id")
    assert all(again[k] == n for k, n in fewer.items()) and len(again) > len(fewer)
    assert versions.vacuum(spark, root) > 0 and spark.table("gold.fact_sales").count() > 0
    assert len({v for v, _ in versions.history(spark, root)}) == version + 3


def test_variance_rows(spark):
    assert versions.variance(None, 5) is None and versions.variance(0, 5) is None
    assert versions.variance(10, None) == 1.0 and versions.variance(10, 12) == 0.2
    root = work_path(spark, "deliveries")
    assert quality.row_count_variance(spark, root, 0.1).count() == 0
    for tables in ({"a": 10, "b": 10, "gone": 3, "none": 0}, {"a": 10, "b": 5, "new": 1, "none": 4}):
        one = versions.Load(spark, root)
        for name, n in tables.items():
            one.write(name, spark.range(n))
        one.commit()
    rows = {r.table_name: (r.previous_rows, r.row_count, r.variance, r.passed) for r in quality.row_count_variance(spark, root, 0.1).collect()}
    assert rows == {
        "a": (10, 10, 0.0, True), "b": (10, 5, 0.5, False), "gone": (3, 0, 1.0, False), "new": (None, 1, None, True), "none": (0, 4, None, True)
    }


def test_registry_only_grows(spark):
    root = work_path(spark, "keys")
    register = lambda names: {
        r.k: r.n for r in keys.registered(spark.createDataFrame([(x,) for x in names], "k string"), "k", root, "n").collect()
    }
    assert register(["c", "a", "b", "b", None]) == {"a": 1, "b": 2, "c": 3, None: None}
    version = versions.newest_version(spark, root)
    assert register(["b", "c"]) == {"b": 2, "c": 3} and versions.newest_version(spark, root) == version
    assert register(["aa", "z", "b"]) == {"b": 2, "aa": 4, "z": 5}
    assert register([]) == {} and register(["a"]) == {"a": 1}


def test_registry_of_many_keys_is_dense(spark):
    root = work_path(spark, "keys")
    spark.range(0, 5000, 3).createOrReplaceTempView("third")
    first = keys.register(spark.table("third"), "id", root, "n")
    numbers = {r.id: r.n for r in first.collect()}
    second = {r.id: r.n for r in keys.register(spark.range(5000).repartition(7), "id", root, "n").collect()}
    assert sorted(second.values()) == list(range(1, 5001)) and all(second[k] == n for k, n in numbers.items())
    new = [second[k] for k in sorted(second) if k not in numbers]
    assert new == list(range(len(numbers) + 1, 5001))


def test_a_table_of_other_columns_is_pointed_anew(spark):
    sinks.create_namespaces(spark, ("pointed",), root=work_path(spark, "db"))
    paths = [work_path(spark, "t") for _ in range(3)]
    spark.range(3).write.parquet(paths[0])
    spark.range(5).write.parquet(paths[1])
    spark.range(7).select(F.col("id").cast("string").alias("x")).write.parquet(paths[2])
    for path, rows, column in zip(paths, (3, 5, 7), ("id", "id", "x")):
        sinks.point_table(spark, "pointed.t", path)
        assert spark.table("pointed.t").count() == rows and spark.table("pointed.t").columns == [column]
    assert spark.read.parquet(paths[0]).count() == 3
    spark.sql("DROP DATABASE pointed CASCADE")
