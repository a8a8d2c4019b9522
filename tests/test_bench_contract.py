"""bench.py prints exactly one JSON line with the agreed keys."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line(small_dir):
    env = dict(os.environ, BENCH_SF_DIR=small_dir, BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "revenue_trend"],
                         capture_output=True, text=True, env=env, timeout=600, check=True)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    doc = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(doc)
    assert doc["unit"] == "sec" and "revenue_trend" in doc["queries"] and doc["sf"] == 0.001
