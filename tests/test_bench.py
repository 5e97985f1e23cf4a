"""bench.py prints exactly one JSON line with the driver's keys."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_DRIVER_MEMORY="2g")
    r = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "route_page_views",
                        "abandoned_carts"], env=env, capture_output=True, text=True, timeout=600)
    lines = [ln for ln in r.stdout.splitlines() if ln.strip()]
    assert r.returncode == 0 and len(lines) == 1
    out = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(out)
    assert out["unit"] == "sec" and set(out["queries"]) == {"route_page_views", "abandoned_carts"}
