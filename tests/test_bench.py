"""bench.py prints exactly one JSON line with the contract's keys (sf0.001, 2 cores)."""

from __future__ import annotations

import json
import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_contract():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2")
    out = subprocess.run(
        [sys.executable, os.path.join(REPO, "bench.py")],
        env=env,
        capture_output=True,
        text=True,
        timeout=900,
        check=True,
    ).stdout
    lines = [line for line in out.splitlines() if line.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(result)
    assert result["unit"] == "sec" and result["sf"] == 0.001 and result["checks_ok"] is True
    assert abs(result["value"] - sum(result["queries"].values())) < 0.01
