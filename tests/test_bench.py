"""bench.py prints exactly one JSON line in the driver's format."""

from __future__ import annotations

import json
import os
import subprocess
import sys

from tests.conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2", BENCH_QUERIES="total_sales,dedup_latest")
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True, text=True, timeout=600
    )
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    record = json.loads(lines[0])
    assert record["unit"] == "sec" and record["sf"] == 0.001 and record["metric"]
    assert set(record["queries"]) == {"total_sales", "dedup_latest"}
    assert abs(record["value"] - sum(record["queries"].values())) < 0.01
    assert "failed" not in record
