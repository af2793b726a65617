"""Build the model into a warehouse folder and run the checks.

    python -m finmart.run --data /path/to/sources --warehouse /shared/wh \
        [--layer source|bronze|snapshot|silver|gold] [--history] [--as-of TS]
        [--bucketed] [--carry-versions] [--cluster-customers] [--reproducible] [--standin-costs] [--report-as-of DATE]
        [--checks] [--store-failures]

A build is one snapshot run: the open rows of the previous snapshot version (if
any) are merged with the current customer extract as of ``--as-of`` (default:
now, UTC) and published as a new version.  The same ``--as-of`` again changes
nothing, an older one is refused.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import uuid

from pyspark.sql import SparkSession

from finmart.operators.scd2 import set_aside_counts
from finmart.plans import quality
from finmart.plans.catalogue import CATALOGUE
from finmart.plans.pipeline import LAYERS, BuildOptions, build_models
from finmart.session import ensure_checkpoint_dir, freed_shuffles, get_spark, size_shuffles
from finmart.sources import sinks
from finmart.sources.history import HISTORY_RUNS
from finmart.sources.reader import read_source


def build(spark: SparkSession, data_dir: str, warehouse: str,
          options: BuildOptions | None = None, layer: str | None = None,
          observed: dict | None = None, catalog: bool = True) -> dict:
    """Persisted build.  Returns the models (tables read back from the warehouse).
    ``observed`` takes the counts of the row-level checks of the tables written;
    without ``catalog`` the tables are folders only."""
    o = options or BuildOptions()
    ensure_checkpoint_dir(spark)
    n_lines = read_source(spark, data_dir, "lineitem").count()
    size_shuffles(spark, n_lines)
    mat = sinks.table_materializer(
        spark, warehouse, catalog=catalog, bucketed=o.bucketed, clustered=o.clustered,
        watch=None if observed is None else quality.row_level_counts(), observed=observed)
    as_of = HISTORY_RUNS[-1] if o.history else o.as_of
    fresh = sinks.check_snapshot_time(spark, warehouse, as_of)
    prev = None if o.history else sinks.read_latest_snapshot(spark, warehouse, open_only=True)

    def materialize(name, df):
        if name == "snap_customer_scd2":
            if not fresh:  # this version is published already
                return sinks.read_latest_snapshot(spark, warehouse).select(*df.columns)
            return sinks.write_snapshot_version(df, warehouse, as_of)
        if name == sinks.SET_ASIDE:
            return sinks.store_set_aside(df, warehouse, as_of, fresh)
        return mat(name, df)

    gold = layer in (None, "gold")
    with freed_shuffles(spark):
        models = build_models(spark, data_dir, o, materialize, layer, previous_snapshot=prev,
                              price_shares=sinks.join_parts(n_lines) if gold else 1)
    # the steps to the fact are gone once it is written; views may run more than once
    steps = {sinks.PRICED_LINES, sinks.FACT_ROWS} if gold else set()
    return {name: df.select("*") for name, df in models.items() if name not in steps}


def run_checks(spark: SparkSession, models: dict, warehouse: str | None = None,
               store_failures: bool = False, observed: dict | None = None, catalogue: list = CATALOGUE):
    summary = quality.run_checks(models, catalogue, observed=observed).cache()
    rows = summary.orderBy("check_id").collect()  # one row per declared check
    if store_failures and warehouse:
        for r in rows:
            if r["failures"]:
                c = catalogue[r["check_id"] - 1]
                sinks.store_failures(quality.check_failures(c, models), warehouse,
                                     r["check_id"], c.label)
    summary.unpersist()
    return rows


def main(argv=None):
    ap = argparse.ArgumentParser()
    ap.add_argument("--data", required=True)
    ap.add_argument("--warehouse", required=True)
    ap.add_argument("--layer", choices=sorted(LAYERS))
    ap.add_argument("--history", action="store_true")
    ap.add_argument("--as-of")
    ap.add_argument("--bucketed", action="store_true",
                    help="bucket silver orders/lineitem by order_id (flat key distributions)")
    ap.add_argument("--cluster-customers", action="store_true",
                    help="the fact's files of a month hold ranges of customers that don't overlap")
    ap.add_argument("--carry-versions", action="store_true",
                    help="as-of join by sorting, for customers with very many versions")
    ap.add_argument("--reproducible", action="store_true",
                    help="fixed load time and batch id instead of now / a fresh run id")
    ap.add_argument("--standin-costs", action="store_true",
                    help="without a partsupp table, make up unit costs (test data only)")
    ap.add_argument("--report-as-of", help="end of the report window (default: latest order date)")
    ap.add_argument("--checks", action="store_true")
    ap.add_argument("--store-failures", action="store_true")
    a = ap.parse_args(argv)
    spark = get_spark()
    run_meta = {} if a.reproducible else {
        "ingested_at": None, "batch_id": f"run-{uuid.uuid4().hex[:12]}",
        "as_of": dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")}
    if a.as_of:
        run_meta["as_of"] = a.as_of
    opts = BuildOptions(history=a.history, bucketed=a.bucketed, carry_versions=a.carry_versions,
                        clustered=a.cluster_customers, standin_costs=a.standin_costs,
                        report_as_of=a.report_as_of, **run_meta)
    observed = {} if a.checks else None
    models = build(spark, a.data, a.warehouse, opts, a.layer, observed)
    if a.layer in (None, "snapshot"):
        counts = set_aside_counts(models[sinks.SET_ASIDE], "customer").collect()  # a row per reason
        print(json.dumps({"snapshot_set_aside": {r["reason"]: r["failures"] for r in counts},
                          "status": "warn" if counts else "pass"}))
    if a.checks:
        rows = run_checks(spark, models, a.warehouse, a.store_failures, observed)
        failed = [r.asDict() for r in rows if r["status"] == "fail"]
        print(json.dumps({"checks": len(rows), "failed": len(failed),
                          "warned": sum(r["status"] == "warn" for r in rows)}))


if __name__ == "__main__":
    main()
