"""Persisted build (catalog tables, versioned snapshot, failure store) and the
incremental / streaming jobs on sf0.001."""

import os
import tempfile

from pyspark.sql import functions as F

from paths import SF_SMALL
from finmart.plans.pipeline import BuildOptions, Models
from finmart.run import build, run_checks
from finmart.sources import sinks
from finmart.streaming import jobs


def test_persisted_build_snapshot_versions_and_checks(spark):
    wh = tempfile.mkdtemp(prefix="finmart-wh-")
    m1 = build(spark, SF_SMALL, wh, BuildOptions(standin_costs=True))
    assert m1["fct_sales_lineitem"].count() == 6000
    assert spark.catalog.tableExists("gold_profitability.fct_sales_lineitem")
    # second run, same extract, later time: snapshot unchanged, new version directory
    m2 = build(spark, SF_SMALL, wh, BuildOptions(as_of="1996-01-01 00:00:00", standin_costs=True))
    assert len(sinks.snapshot_versions(spark, wh)) == 2
    assert m2["snap_customer_scd2"].filter(F.col("scd_valid_to").isNotNull()).count() == 0
    rows = run_checks(spark, m2, wh, store_failures=True)
    assert len(rows) == 182
    failed = {r["check_id"] for r in rows if r["status"] == "fail"}
    # only the grain checks fail on the delivered data (duplicated order/line pairs)
    assert {rows[i - 1]["check_name"] for i in failed} <= {"unique", "unique_combination"}
    assert len(os.listdir(os.path.join(wh, "check_failures"))) == len(failed)


def test_incremental_fact_equals_full_fact(spark):
    m = Models(spark, SF_SMALL, BuildOptions(standin_costs=True))
    inc = jobs.incremental_fact(spark, m)
    full = m["fct_sales_lineitem"]
    assert inc.count() == full.count()
    assert inc.select("sales_lineitem_key", "gross_margin").exceptAll(
        full.select("sales_lineitem_key", "gross_margin")).count() == 0


def test_stream_landing_is_exactly_once_per_batch(spark):
    first = jobs.orders_stream(spark, SF_SMALL)
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    assert first.count() == orders.count()
    assert first.exceptAll(orders).count() == 0


def test_hwm_ingest_loads_everything_once(spark):
    out = jobs.orders_hwm(spark, SF_SMALL)
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    assert out.count() == orders.count() and out.exceptAll(orders).count() == 0


def test_report_refresh_stream_equals_batch_report(spark):
    m = Models(spark, SF_SMALL, BuildOptions(standin_costs=True))
    streamed = jobs.report_refresh(spark, m, SF_SMALL)
    batch = m["rpt_customer_profitability_90d"]
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch.select(*streamed.columns)).count() == 0


def test_layer_selection_writes_only_that_layer(spark):
    wh = tempfile.mkdtemp(prefix="finmart-wh-")
    build(spark, SF_SMALL, wh, BuildOptions(standin_costs=True), layer="snapshot")
    # a snapshot run stores what it leaves out beside the snapshot
    assert sorted(os.listdir(wh)) == ["quarantine", "silver_customer"]
    assert os.listdir(os.path.join(wh, "quarantine")) == ["snap_customer_set_aside"]
    assert os.listdir(os.path.join(wh, "silver_customer")) == ["snap_customer_scd2"]


def _same_rows(a, b):
    cols = [c for c in b.columns if not c.startswith("_")]
    a, b = a.select(*cols), b.select(*cols)
    return a.count() == b.count() and a.exceptAll(b).count() == 0


def test_redated_and_late_orders_equal_a_rebuild(spark):
    m = Models(spark, SF_SMALL, BuildOptions(standin_costs=True))
    full = m["fct_sales_lineitem"].checkpoint()
    assert _same_rows(jobs.redated_order(spark, m), full)
    assert _same_rows(jobs.late_order(spark, m), full)


def test_a_month_that_empties_disappears(spark):
    m = Models(spark, SF_SMALL, BuildOptions(standin_costs=True))
    sales = jobs.landed_sales(spark, m)
    first = F.col("order_id") == m["orders"].agg(F.min("order_id")).first()[0]
    lines, order = m["lineitem"].filter(first), m["orders"].filter(first)
    sales.land(1, lines, order)
    assert sales.merge(1).count() == lines.count()
    sales.land(2, orders=order.withColumn("order_date", F.date_add("order_date", 400)))
    fact = sales.merge(2)
    assert fact.count() == lines.count()
    assert fact.select("order_year_month_key").distinct().count() == 1
    sales.land(2, orders=order.withColumn("order_date", F.date_add("order_date", 400)))  # runs again
    assert sales.merge(2).count() == lines.count()


def test_report_refresh_does_not_depend_on_file_layout(spark):
    m = Models(spark, SF_SMALL, BuildOptions(standin_costs=True))
    batch = m["rpt_customer_profitability_90d"].checkpoint()
    folder = tempfile.mkdtemp(prefix="finmart-src-")
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    lines.repartition(24).write.parquet(f"{folder}/lineitem.parquet")
    for max_files in (None, 9):
        assert _same_rows(jobs.report_refresh(spark, m, folder, max_files=max_files), batch)


def test_stream_landing_reads_a_folder_of_part_files(spark):
    folder = tempfile.mkdtemp(prefix="finmart-src-")
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    orders.repartition(5).write.parquet(f"{folder}/orders.parquet")
    assert _same_rows(jobs.orders_stream(spark, folder), orders)


def test_hwm_ingest_keeps_ties_late_rows_and_rows_without_time(spark):
    from finmart.streaming.incremental import hwm_ingest
    path = tempfile.mkdtemp(prefix="finmart-hwm-") + "/t"
    rows = [(1, "2020-01-01"), (2, "2020-01-02"), (3, "2020-01-02"), (4, "2020-01-01"), (5, None),
            (6, "2020-01-03"), (6, "2020-01-03")]
    df = spark.createDataFrame(rows, "id int, d string").withColumn("d", F.col("d").cast("date"))
    hwm_ingest(spark, df.filter("id <= 2"), path, "d")
    hwm_ingest(spark, df, path, "d")
    hwm_ingest(spark, df, path, "d")  # nothing new
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 2, 3, 4, 5, 6, 6]
    more = df.union(spark.createDataFrame([(7, "2019-01-01"), (8, "2020-01-02")], "id int, d string")
                    .withColumn("d", F.col("d").cast("date")))
    hwm_ingest(spark, more, path, "d", key=["id"], lateness="2 days")
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 2, 3, 4, 5, 6, 6, 8]


def test_snapshot_store_keeps_its_history(spark):
    import pytest
    from finmart.operators.scd2 import scd2_snapshot
    wh = "file://" + tempfile.mkdtemp(prefix="finmart-snap-")
    one = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    two = spark.createDataFrame([(1, "a"), (2, "B")], "k int, v string")

    def run(extract, as_of):
        prev = sinks.read_latest_snapshot(spark, wh, open_only=True)
        sinks.write_snapshot_version(scd2_snapshot(prev, extract, "k", ["v"], as_of), wh, as_of)
        rows = sinks.read_latest_snapshot(spark, wh).collect()
        return sorted((r.k, r.v, r.scd_valid_to is None) for r in rows)

    first = [(1, "a", True), (2, "b", True), (3, "c", True)]
    assert run(one, "1995-01-01 00:00:00") == first
    assert run(one, "1995-01-01") == first  # the same time again: nothing changes
    # a run that died before it was published leaves a folder that nothing names
    one.withColumn("scd_valid_to", F.lit(None).cast("timestamp_ntz")).write.parquet(
        f"{sinks.snapshot_root(wh)}/versions/20250101000000000000-dead/state=open")
    second = [(1, "a", True), (2, "B", True), (2, "b", False), (3, "c", False)]
    assert run(two, "2026-01-01") == second  # a date alone is later than a 1995 timestamp
    assert run(two, "2026-01-01 00:00:00") == second
    assert run(two, "2026-02-01") == second
    with pytest.raises(ValueError):
        run(two, "2020-01-01")
    with pytest.raises(ValueError):
        run(two, "some day")
    assert len(sinks.snapshot_versions(spark, wh)) == 3


def test_build_twice_as_of_the_same_time(spark):
    wh = tempfile.mkdtemp(prefix="finmart-wh-")
    options = BuildOptions(standin_costs=True)
    first = build(spark, SF_SMALL, wh, options, layer="snapshot")["snap_customer_scd2"].count()
    assert build(spark, SF_SMALL, wh, options, layer="snapshot")["snap_customer_scd2"].count() == first


def test_costs_are_never_made_up_silently(spark):
    import pytest
    from finmart.sources.reader import read_source
    with pytest.raises(FileNotFoundError):
        read_source(spark, SF_SMALL, "partsupp")
    assert read_source(spark, SF_SMALL, "partsupp", standin_costs=True).count() > 0
    folder = "file://" + tempfile.mkdtemp(prefix="finmart-src-")
    spark.createDataFrame([(1, 2, "3.50")], "ps_partkey int, ps_suppkey int, ps_supplycost string") \
        .withColumn("ps_supplycost", F.col("ps_supplycost").cast("decimal(12,2)")) \
        .write.parquet(f"{folder}/partsupp.parquet")
    for asked in (False, True):
        assert [str(r.ps_supplycost) for r in read_source(spark, folder, "partsupp", asked).collect()] == ["3.50"]


def test_report_window_ends_at_the_given_date(spark):
    m = Models(spark, SF_SMALL, BuildOptions(standin_costs=True, report_as_of="1999-06-30"))
    rows = m["rpt_customer_profitability_90d"]
    lines = m["fct_sales_lineitem"].filter("order_date BETWEEN date'1999-04-01' AND date'1999-06-30'")
    assert rows.agg(F.sum("lineitem_count")).first()[0] == lines.count() > 0
