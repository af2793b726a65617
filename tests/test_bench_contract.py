"""bench.py prints exactly one JSON line with the fields the driver records."""

import json
import os
import subprocess
import sys

from paths import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=900, check=True).stdout
    lines = [ln for ln in out.splitlines() if ln.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == "0.001" and d["value"] > 0
    assert {"build_fct_sales_lineitem", "rpt_customer_profitability_90d",
            "a12_scd2_footprint", "check_summary_182"} <= set(d["queries"])
