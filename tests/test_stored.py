"""The store read back: builds, replaced tables, versions, failures, load times."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from finmart.plans import stored
from finmart.plans.pipeline import Models, BuildOptions
from finmart.sources import faults, sinks
from finmart.sources.storage import child_names
from harness import compare, duck
from paths import SF_SMALL

STORE = ["stored_fct_sales_lineitem", "stored_snap_customer_scd2", "stored_layers", "stored_view",
         "stored_snapshot_versions", "stored_dim_part_replaced", "stored_check_failures",
         "load_time_now", "source_freshness_feeds"]


@pytest.mark.parametrize("name", STORE)
def test_matches_oracle(spark, name):
    n, problems = compare(spark, duck(SF_SMALL), SF_SMALL, name, E.queries()[name], E.oracle_sql()[name])
    assert n and not problems, problems


def test_views_are_not_stored_and_stay_in_their_session(spark):
    session, warehouse = E._built(spark, SF_SMALL)
    assert not sinks.VIEWS & set(child_names(spark, f"{warehouse}/gold_profitability"))
    assert session.catalog.tableExists("rpt_customer_profitability_90d")
    assert not spark.catalog.tableExists("rpt_customer_profitability_90d")


def test_an_older_state_leaves_nothing(spark):
    part = Models(spark, SF_SMALL, BuildOptions(standin_costs=True))["part"]
    older = faults.older_parts(part)
    assert older.count() == 2 * part.count() and not older.filter("part_name NOT LIKE 'before: %'").count()
    left = stored.replaced_table(spark, "part", [older, part])
    assert left.count() == part.count() and not left.filter("part_id < 0 OR part_name LIKE 'before: %'").count()


def test_feeds_have_every_state(spark):
    rows = spark.createDataFrame([("a", "2024-01-03"), ("a", "2023-01-01"), ("b", "2024-01-02"),
                                  ("c", "2024-01-01"), ("d", None)], "feed string, d string")
    out = stored.stale_feeds(rows.withColumn("d", F.to_date("d")), "feed", "d", 24, 48)
    assert {r.feed: (r.status, r.age_hours and float(r.age_hours)) for r in out.collect()} == {
        "a": ("pass", 12.0), "b": ("warn", 36.0), "c": ("error", 60.0), "d": ("error", None)}


def test_snapshot_versions_keep_closed_rows(spark):
    customer = Models(spark, SF_SMALL, BuildOptions(standin_costs=True))["tpch_customer"]
    rows = stored.snapshot_versions(spark, customer)
    closed = rows.filter("scd_valid_to IS NOT NULL")
    assert closed.count() and closed.join(rows.filter("scd_valid_to IS NULL"), "c_custkey").count()
