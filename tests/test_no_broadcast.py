"""With broadcasting disabled -- what the planner does when dimensions exceed
the broadcast threshold at scale -- the queries take the sort-merge path and
return exactly the same rows."""

from __future__ import annotations

import pytest

from martlet.plans.catalog import CATALOG
from tests.conftest import SF_SMALL

QUERIES = ["customer_report", "sales_by_category", "fact_sales", "revenue_per_customer", "dim_products"]
OFF = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


def _final_plan(df) -> str:
    qe = df._jdf.queryExecution()
    qe.executedPlan().execute().count()
    plan = qe.executedPlan().toString()
    return plan.split("== Initial Plan ==", 1)[0]


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows_without_broadcast(spark, name):
    expected = CATALOG[name](spark, SF_SMALL).collect()
    saved = {k: spark.conf.get(k, None) for k in OFF}
    try:
        for k, v in OFF.items():
            spark.conf.set(k, v)
        df = CATALOG[name](spark, SF_SMALL)
        got = df.collect()
        plan = _final_plan(df)
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, expected), key=repr)
    if name != "dim_products":
        assert "SortMergeJoin" in plan
