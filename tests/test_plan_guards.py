"""Scale guards on the physical plans of the registered queries: no
cartesian products, no nested-loop joins, no Python UDF evaluation, and the
fact join reads the bucketed silver tables without an exchange in a
persisted (bucketed) build."""

import re
import tempfile

import pytest

import __spark_entry__ as E
from paths import SF_SMALL

# Jobs that leave a written table: their plan is a scan.  The optional operators
# have tests of their own.
SKIP = {"incremental_fact", "incremental_redated_order", "incremental_late_order",
        "hwm_ingest", "hwm_ingest_late", "stream_ingest", "refresh_to_lag",
        "check_summary", "check_summary_history", "pipeline",
        *getattr(E.llm_queries, "QUERIES", ())}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(E.queries()) - SKIP))
def test_no_cartesian_no_python(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "EvalPython" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_unfrozen_models_without_broadcasts(spark):
    """The plans behind the frozen tables, as they are when no side is small."""
    from finmart.plans.pipeline import BuildOptions, Models
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    try:
        for history in (False, True):
            m = Models(spark, SF_SMALL, BuildOptions(history=history, standin_costs=True))
            for name in ("snap_customer_scd2", "dim_customer", "dim_supplier", "fct_sales_lineitem",
                         "rpt_customer_profitability_90d", "rpt_segment_margin_concentration"):
                plan = _plan(m[name])
                for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Arrow"):
                    assert bad not in plan, (name, bad)
            lines = _plan(m["fct_sales_lineitem"])
        # the lines (the only input with a discount) are shuffled by order and by pair alone
        wide = [x for x in lines.splitlines() if "Exchange hashpartitioning" in x]
        assert sum("order_id" in x for x in wide) <= 2 and any("part_id" in x for x in wide)
    finally:
        for n, v in before.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def test_frozen_report_reads_its_columns_and_months(spark):
    from finmart.plans.pipeline import SHARED_MODELS, BuildOptions, Models
    m = Models(spark, SF_SMALL, BuildOptions(standin_costs=True), SHARED_MODELS)
    scan = [x for x in m["fct_sales_lineitem"].groupBy("order_priority").count()
            ._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x]
    assert len(scan) == 1 and "order_priority" in scan[0] and "net_revenue" not in scan[0]
    plan = _plan(m["rpt_customer_profitability_90d"])
    assert re.search(r"PartitionFilters: \[[^\]]*order_year_month_key", plan)


def test_bucketed_fact_join_without_exchange(spark):
    from finmart.plans.pipeline import BuildOptions
    from finmart.run import build
    wh = tempfile.mkdtemp(prefix="finmart-wh-")
    m = build(spark, SF_SMALL, wh, BuildOptions(bucketed=True, standin_costs=True))
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        lines = m["lineitem"].select("order_id", "line_number")
        j = lines.join(m["orders"].select("order_id", "customer_id"), "order_id")
        plan = _plan(j)
        assert "SortMergeJoin" in plan
        assert not re.search(r"Exchange hashpartitioning\(order_id", plan)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
