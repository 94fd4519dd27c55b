"""bench.py prints exactly one JSON line with the driver's keys."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SF001


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF001, BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "typical_price", "sma20"],
                         capture_output=True, text=True, env=env, timeout=600, cwd="/tmp")
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(d)
    assert d["unit"] == "sec" and d["sf"] == 0.001
    assert set(d["queries"]) == {"typical_price", "sma20"}
    assert abs(d["value"] - sum(d["queries"].values())) < 1e-6
