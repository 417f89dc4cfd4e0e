"""Invariants of every registered query's final (adaptive) physical plan:
no Python UDFs, no nested-loop or Cartesian joins, and every single-partition
exchange sits directly on an aggregate or a limit -- never on raw rows."""

from __future__ import annotations

import pytest

from martlet.plans.catalog import CATALOG
from tests.conftest import SF_SMALL

ALLOWED_UNDER_SINGLE_PARTITION = ("HashAggregate", "ObjectHashAggregate", "SortAggregate", "TakeOrderedAndProject",
                                  "LocalLimit", "GlobalLimit", "CollectLimit")


def final_plan(df) -> str:
    qe = df._jdf.queryExecution()
    qe.executedPlan().execute().count()  # run it so the adaptive plan is final
    plan = qe.executedPlan().toString()
    if "== Final Plan ==" in plan:
        plan = plan.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
    return plan


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_final_plan_invariants(spark, name):
    plan = final_plan(CATALOG[name](spark, SF_SMALL))
    for banned in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "BroadcastNestedLoopJoin", "CartesianProduct",
                   "RoundRobinPartitioning"):
        assert banned not in plan, banned
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            child = lines[i + 1]
            # AQE wraps materialised stages; look through the stage wrapper
            # look through stage wrappers and row-preserving narrow operators
            j = i + 1
            while any(w in lines[j] for w in ("ShuffleQueryStage", "AQEShuffleRead", "InputAdapter",
                                              "Project [", "Filter ")):
                j += 1
                child = lines[j]
            assert any(op in child for op in ALLOWED_UNDER_SINGLE_PARTITION), f"{name}: {child.strip()}"
