"""bench.py prints exactly one JSON line with the fields the driver reads."""

import json
import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_bench_prints_one_json_line():
    env = {**os.environ, "BENCH_SF_DIR": "/root/testdata/sf0.001", "BENCH_REPEATS": "1", "BENCH_CPUS": "2"}
    out = subprocess.run([sys.executable, str(ROOT / "bench.py"), "A2_pivot_count"], env=env, cwd=ROOT,
                         capture_output=True, text=True, timeout=600)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1, out.stdout + out.stderr
    rec = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(rec)
    assert rec["unit"] == "sec" and rec["sf"] == 0.001 and rec["queries"]["A2_pivot_count"] > 0
