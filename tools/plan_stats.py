"""Per query: shuffle exchanges, single-partition exchanges and broadcasts in
the final (adaptive) physical plan, after executing the query's own plan.

Usage: python tools/plan_stats.py [sf_dir] [name ...]   -> one JSON line
"""

from __future__ import annotations

import json
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from martlet.plans.catalog import CATALOG  # noqa: E402
from martlet.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(CATALOG)
    spark = build_session()
    out = {}
    for name in names:
        df = CATALOG[name](spark, sf_dir)
        qe = df._jdf.queryExecution()
        qe.executedPlan().execute().count()  # run this plan so AQE finalises it
        plan = qe.executedPlan().toString()
        # an adaptive plan prints its final plan, then the initial one
        if "== Final Plan ==" in plan:
            plan = plan.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
        out[name] = {
            "shuffles": len(re.findall(r"\bExchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)", plan)),
            "single_partition": len(re.findall(r"Exchange SinglePartition", plan)),
            "broadcasts": len(re.findall(r"BroadcastExchange", plan)),
            "sort_merge_joins": len(re.findall(r"SortMergeJoin", plan)),
            "broadcast_joins": len(re.findall(r"BroadcastHashJoin", plan)),
            "python_udfs": len(re.findall(r"PythonUDF|ArrowEvalPython|BatchEvalPython", plan)),
            "nested_loop_or_cartesian": len(re.findall(r"BroadcastNestedLoopJoin|CartesianProduct", plan)),
        }
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
