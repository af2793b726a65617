"""Benchmark: persisted build + reports + analyst queries + full check run.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints one JSON line.  The warehouse goes under the session's checkpoint
folder (a fresh sub-folder per run).
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from finmart import get_spark  # noqa: E402
from finmart.plans import analyses, quality  # noqa: E402
from finmart.plans.pipeline import BuildOptions  # noqa: E402
from finmart.run import build  # noqa: E402
from finmart.session import scratch_path  # noqa: E402
from finmart.sources import sinks  # noqa: E402


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark(f"local[{cpus}]", app="finmart-bench", shuffle_partitions=cpus,
                      extra={"spark.driver.memory": "16g"})
    warehouse = scratch_path(spark, f"bench-{uuid.uuid4().hex[:8]}")
    times: dict[str, float] = {}

    # Per-model build times, recorded through the materialize hook.
    per_model: dict[str, float] = {}
    orig = sinks.table_materializer

    def timed_materializer(*a, **k):
        inner = orig(*a, **k)

        def materialize(name, df):
            t0 = time.time()
            out = inner(name, df)
            per_model[name] = time.time() - t0
            return out
        return materialize

    sinks.table_materializer = timed_materializer
    t = time.time()
    models = build(spark, sf_dir, warehouse, BuildOptions(standin_costs=True))
    total_build = time.time() - t
    sinks.table_materializer = orig
    times["build_fct_sales_lineitem"] = per_model.get("fct_sales_lineitem", 0.0)
    times["build_other_layers"] = total_build - times["build_fct_sales_lineitem"]

    def timed(name, df_fn):
        # Run the whole query without moving its result to the driver.
        t0 = time.time()
        df_fn().write.format("noop").mode("overwrite").save()
        times[name] = time.time() - t0

    timed("rpt_customer_profitability_90d", lambda: models["rpt_customer_profitability_90d"])
    timed("rpt_segment_margin_concentration", lambda: models["rpt_segment_margin_concentration"])
    for name in analyses.ANALYSES:
        timed(name, lambda name=name: analyses.run_analysis(name, models))
    timed("check_summary_182", lambda: quality.run_checks(models))

    total = sum(times.values())
    print(json.dumps({"metric": "total_wall_sec", "value": round(total, 3), "unit": "sec",
                      "queries": {k: round(v, 3) for k, v in times.items()},
                      "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", "")}))
    spark.stop()


if __name__ == "__main__":
    main()
