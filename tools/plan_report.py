"""Summarise the executed plans of the headline queries over a persisted build.

    python tools/plan_report.py [sf_dir] > PLANS.md

For each query: join strategies, shuffles (exchanges), skew-split joins,
pushed parquet filters and partition filters of the final adaptive plan.
"""

from __future__ import annotations

import os
import re
import sys
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from finmart import get_spark  # noqa: E402
from finmart.plans import analyses, quality  # noqa: E402
from finmart.plans.gold import fct_sales_lineitem  # noqa: E402
from finmart.plans.pipeline import BuildOptions  # noqa: E402
from finmart.run import build  # noqa: E402
from finmart.session import scratch_path  # noqa: E402


def summarise(df) -> dict:
    df.collect()
    qe = df._jdf.queryExecution()
    final = qe.executedPlan().toString().split("== Initial Plan ==")[0]
    formatted = df.sparkSession._jvm.PythonSQLUtils.explainString(qe, "formatted")
    joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin(?:\(skew=true\))?|"
                       r"ShuffledHashJoin|BroadcastNestedLoopJoin)[^\n]*?(Inner|LeftOuter|LeftAnti|"
                       r"LeftSemi|FullOuter|Cross)?", final)
    kinds: dict[str, int] = {}
    for j, t in joins:
        k = f"{j} {t}".strip()
        kinds[k] = kinds.get(k, 0) + 1
    exchanges = len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|"
                               r"Exchange SinglePartition|Exchange RoundRobin", final))
    clean = lambda t: re.sub(r"#\d+L?|, \[id=[^\]]*\]", "", t)
    pushed = sorted({clean(p) for p in re.findall(r"^PushedFilters: \[(.+)\]$", formatted, re.M)})
    parts = sorted({clean(p) for p in re.findall(r"^PartitionFilters: \[(.+)\]$", formatted, re.M)})
    return {"joins": kinds, "exchanges": exchanges, "pushed": pushed, "partition": parts}


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark("local[8]", shuffle_partitions=8,
                      extra={"spark.driver.memory": "8g", "spark.sql.maxMetadataStringLength": "1000"})
    m = build(spark, sf_dir, scratch_path(spark, f"plans-{uuid.uuid4().hex[:8]}"),
              BuildOptions(standin_costs=True))
    items = {
        "fct_sales_lineitem (rebuild from silver)": fct_sales_lineitem(
            m["lineitem"], m["orders"], m["dim_customer"], m["partsupp"], m["dim_supplier"],
            m["dim_part"], m["dim_geography"]),
        "rpt_customer_profitability_90d": m["rpt_customer_profitability_90d"],
        "rpt_segment_margin_concentration": m["rpt_segment_margin_concentration"],
        **{a: analyses.run_analysis(a, m) for a in analyses.ANALYSES},
        "check_summary (182 checks)": quality.run_checks(m),
    }
    print(f"# Executed plans at {os.path.basename(sf_dir)} (persisted build, local[8])\n")
    print("Generated by `tools/plan_report.py`; final adaptive plans.\n")
    for name, df in items.items():
        s = summarise(df)
        joins = ", ".join(f"{k} ×{v}" for k, v in sorted(s["joins"].items())) or "none"
        print(f"## {name}\n")
        print(f"* joins: {joins}")
        print(f"* exchanges (shuffles): {s['exchanges']}")
        for p in s["partition"][:3]:
            print(f"* partition filters: `{p[:300]}`")
        for p in s["pushed"][:4]:
            print(f"* pushed filters: `{p[:300]}`")
        print()
    spark.stop()


if __name__ == "__main__":
    main()
