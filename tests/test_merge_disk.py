"""What the incremental jobs hold on disk: a part of the rows in shuffle files at a time, no shuffle
files of finished queries, no change sets that nobody needs."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from finmart.sources import sinks
from finmart.sources.storage import child_names
from finmart.streaming import incremental, jobs
from finmart.streaming.incremental import LandedSales
from finmart.streaming.landing import LandingLog
from paths import SF_SMALL
from test_build_disk import shuffle_files
from test_landing import fact_of, folder, orders_of, rows

FACT = "fct_sales_lineitem"


@pytest.fixture
def sales_made(monkeypatch):
    made, real = [], jobs.landed_sales
    monkeypatch.setattr(jobs, "landed_sales", lambda *a, **k: made.append(real(*a, **k)) or made[-1])
    return made


def test_a_redated_order_merges_in_parts_and_leaves_no_copies(spark, sales_made, monkeypatch):
    models = E._models(spark, SF_SMALL)
    want, before, writes = models[FACT], shuffle_files(spark), []
    by_month = incremental._by_month
    monkeypatch.setattr(incremental, "_by_month", lambda df, mode="overwrite": writes.append(df) or by_month(df, mode))
    monkeypatch.setattr(sinks, "ROWS_OF_A_PART", 2500)
    fact = jobs.redated_order(spark, models)
    assert not shuffle_files(spark) - before  # those of every finished query were kept
    sales, = sales_made
    assert not [n for n in child_names(spark, f"{sales.root}/changes") if n in sales.merged()]
    assert sales.land_parts == 3 and sales.logs["lines"].state()["buckets"] % sinks.JOIN_PARTS == 0
    # old and new of 3 + 1 parts, and the months in more than one step of at most so many rows
    assert len(writes) > 12 and max(df.count() for df in writes[:2]) < want.count() / 2
    assert fact.exceptAll(want).count() == 0 and want.exceptAll(fact).count() == 0


def test_parts_of_a_landing_hold_its_rows(spark):
    log = LandingLog(spark, folder(), "order_id", buckets=8)
    df = rows(spark, *range(100), line_number=1)
    log.land(1, df, parts=4)
    assert sorted(log.read().select(*df.columns).collect()) == sorted(df.collect())
    assert all(".zstd." in f for f in log.read().inputFiles())


def test_a_merge_keeps_the_other_orders_without_a_date(spark):
    sales = LandedSales(spark, folder(), fact_of, buckets=4)
    sales.land(1, rows(spark, 1, 2, 3, line_number=1), orders_of(spark, (1, None), (2, None), (3, "2020-01-01")))
    assert sales.merge(1).count() == 3
    sales.land(2, orders=orders_of(spark, (1, "2020-02-02")))
    fact = sales.merge(2)  # order 2 went with the folder of order 1 before
    assert sorted((r.order_id, str(r.order_date)) for r in fact.collect()) == [
        (1, "2020-02-02"), (2, "None"), (3, "2020-01-01")]


def test_a_followed_report_leaves_no_change_sets(spark, sales_made):
    models = E._models(spark, SF_SMALL)
    before = shuffle_files(spark)
    report = jobs.report_by_change(spark, models)
    assert not shuffle_files(spark) - before
    sales, = sales_made
    assert len(sales.merged()) == 3 and not child_names(spark, f"{sales.root}/changes")
    want = models["rpt_customer_profitability_90d"]
    assert report.exceptAll(want).count() == 0 and want.exceptAll(report).count() == 0


def test_the_batches_are_split_at_one_day(spark):
    class Landed:
        def __init__(self):
            self.frames = []

        def land(self, _, lines=None, orders=None, replace=False):
            self.frames += [lines, orders]

        def merge(self, _):
            pass

    landed = Landed()
    jobs.changed_sales(spark, E._models(spark, SF_SMALL), landed)
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in landed.frames]
    assert len(plans) == 6 and not any("percentile" in p for p in plans)


@pytest.mark.parametrize("job, n", [("incremental_fact", 2), ("late_order", 2), ("schema_change", 3)])
def test_a_job_drops_each_change_set_after_its_merge(spark, monkeypatch, job, n):
    class Sales:
        def __init__(self):
            self.calls = []

        def __getattr__(self, name):
            return lambda *a, **k: self.calls.append(name)

    sales = Sales()
    monkeypatch.setattr(jobs, "landed_sales", lambda *a, **k: sales)
    getattr(jobs, job)(spark, E._models(spark, SF_SMALL))
    assert sales.calls == ["land", "merge", "vacuum"] * n


def test_a_stream_leaves_neither_change_sets_nor_old_reports(spark, sales_made):
    models = E._models(spark, SF_SMALL)
    report = jobs.report_refresh(spark, models, SF_SMALL)
    sales, = sales_made
    assert sales.merged() and not child_names(spark, f"{sales.root}/changes")
    assert report.count() == models["rpt_customer_profitability_90d"].count()
