"""Land a batch of orders and lines and bring the fact and the report up to date.

    python -m finmart.land --batch /in/2024-06-30 --batch-id 17 --warehouse /shared/wh \
        [--replace] [--on-schema-change ignore|append|sync|fail] [--compact] [--buckets N]

The batch folder holds ``lineitem.parquet``, ``orders.parquet`` or both.  The
dimensions and unit costs are those of the warehouse's last build
(``finmart.run``).  Under ``<warehouse>/incremental`` are the landing log, the fact
by order month, the report's state and the report itself; the work of a batch
grows with the orders it touches, not with what has landed before.  The same
batch id again replaces what that batch landed.  ``--replace``: the batch's lines
stand for all earlier lines of their orders.  ``--compact`` joins the folders of
merged batches and removes what nothing needs any more.  ``--buckets``: the buckets
of a landing log that begins with this batch (about a hundred thousand orders each).
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession

from finmart.plans import gold, silver
from finmart.plans.bronze import bronze
from finmart.session import get_spark
from finmart.sources.reader import read_source
from finmart.sources.sinks import spread_fact, table_path
from finmart.sources.storage import path_exists
from finmart.streaming.incremental import LandedSales
from finmart.streaming.report_state import DayReport
from finmart.streaming.schema_change import POLICIES

_SILVER = {"lines": ("lineitem", silver.silver_lineitem), "orders": ("orders", silver.silver_orders)}
_UPSTREAM = ("dim_customer", "partsupp", "dim_supplier", "dim_part", "dim_geography")


def warehouse_sales(spark: SparkSession, warehouse: str, policy: str = "append",
                    days: int = 90, buckets: int = 256) -> tuple[LandedSales, DayReport, DataFrame]:
    """The landed sales of a warehouse, the report that follows them, and dim_customer."""
    t = {n: spark.read.parquet(table_path(warehouse, n)) for n in _UPSTREAM}
    root = f"{warehouse.rstrip('/')}/incremental"
    sales = LandedSales(spark, root, lambda lines, orders: gold.fct_sales_lineitem(
        lines, orders, *[t[n] for n in _UPSTREAM], spread=spread_fact), buckets=buckets, policy=policy)
    return sales, DayReport(spark, f"{root}/report_state", sales, days, buckets=min(buckets, 64)), t["dim_customer"]


def land_batch(spark: SparkSession, batch_dir: str, batch_id: int, warehouse: str, replace: bool = False,
               policy: str = "append", compact: bool = False, source_system: str = "landing",
               buckets: int = 256) -> dict:
    sales, report, dim_customer = warehouse_sales(spark, warehouse, policy, buckets=buckets)
    now = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    given = {}
    for name, (source, clean) in _SILVER.items():
        if path_exists(spark, f"{batch_dir.rstrip('/')}/{source}.parquet"):
            raw = read_source(spark, batch_dir, source)
            given[name] = clean(bronze(raw, source_system, f"batch-{batch_id}", now))
    if not given:
        raise FileNotFoundError(f"{batch_dir} holds neither lineitem.parquet nor orders.parquet")
    changes = sales.land(batch_id, replace=replace, **given)
    sales.merge(batch_id)
    applied = report.refresh(dim_customer)
    target = f"{sales.root}/rpt_customer_profitability_90d"
    report.report(dim_customer).write.mode("overwrite").parquet(target)
    gone = 0
    if compact:
        gone = sales.compact()
        sales.vacuum(followed=report.state()["applied"])
        report.vacuum()
    return {"batch": batch_id, "landed": sorted(given), "applied": applied, "folders_compacted": gone,
            "schema_changes": {n: [c.as_dict() for c in cs] for n, cs in changes.items() if cs},
            "window": report.state()["window"]}


def main(argv=None):
    ap = argparse.ArgumentParser()
    ap.add_argument("--batch", required=True)
    ap.add_argument("--batch-id", type=int, required=True)
    ap.add_argument("--warehouse", required=True)
    ap.add_argument("--replace", action="store_true")
    ap.add_argument("--on-schema-change", choices=POLICIES, default="append")
    ap.add_argument("--compact", action="store_true")
    ap.add_argument("--buckets", type=int, default=256)
    a = ap.parse_args(argv)
    print(json.dumps(land_batch(get_spark(), a.batch, a.batch_id, a.warehouse, a.replace,
                                a.on_schema_change, a.compact, buckets=a.buckets)))


if __name__ == "__main__":
    main()
