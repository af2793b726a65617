"""Checks counted while tables are written, files clustered by customer, and the
order of unknown measures."""

import tempfile

from pyspark.sql import functions as F

from finmart.plans import analyses, quality
from finmart.plans.catalogue import CATALOGUE
from finmart.plans.pipeline import BuildOptions, Models
from finmart.run import build, run_checks
from finmart.sources import sinks
from paths import SF_SMALL


def test_row_level_checks_are_counted_in_the_write_pass(spark):
    wh = tempfile.mkdtemp(prefix="finmart-wh-")
    observed = {}
    models = build(spark, SF_SMALL, wh, BuildOptions(standin_costs=True), observed=observed)
    written = {c.relation for c in CATALOGUE if c.relation in sinks.MODEL_SCHEMA} - sinks.VIEWS - {"snap_customer_scd2"}
    row_level = {f"check_{i}": c for i, c in enumerate(CATALOGUE, start=1) if c.kind in quality.ROW_LEVEL}
    assert set(observed) == {i for i, c in row_level.items() if c.relation in written}
    with_scan = {r["check_id"]: r for r in run_checks(spark, models)}
    assert {r["check_id"]: r for r in run_checks(spark, models, observed=observed)} == with_scan
    # what was observed is not read again
    only = [c if f"check_{i}" in observed else None for i, c in enumerate(CATALOGUE, start=1)]
    some = [c for c in only if c is not None][:40]
    known = {f"check_{n}": observed[f"check_{CATALOGUE.index(c) + 1}"] for n, c in enumerate(some, start=1)}
    plan = quality.run_checks(models, some, observed=known)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan
    assert "FileScan" in quality.run_checks(models, some)._jdf.queryExecution().executedPlan().toString()


def test_failures_are_observed(spark):
    taken = {}
    df = spark.range(100).select(F.when(F.col("id") % 10 != 0, F.col("id")).alias("x"))
    path = tempfile.mkdtemp(prefix="finmart-obs-") + "/t"
    with sinks.observation("t", df, lambda name: [F.count(F.when(F.col("x").isNull(), 1)).alias("check_1")], taken) as rows:
        sinks.write_table(rows, path)
    assert taken == {"check_1": 10} and spark.read.parquet(path).count() == 100


def test_a_customer_lies_in_few_files_of_a_month(spark):
    path = tempfile.mkdtemp(prefix="finmart-fact-") + "/f"
    fact = spark.range(40_000).select(
        F.md5((F.col("id") % 700).cast("string")).alias("customer_key"), F.col("id").alias("order_id"),
        (F.lit(202001) + F.col("id") % 2).cast("int").alias("order_year_month_key"))
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "24"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        sinks.write_fact(fact, path, clustered=True)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    stored = spark.read.parquet(path)
    assert stored.count() == 40_000
    files = stored.filter("order_year_month_key = 202001").groupBy(F.col("_metadata.file_path").alias("f")).agg(
        F.min("customer_key").alias("lo"), F.max("customer_key").alias("hi")).orderBy("lo").collect()
    assert len(files) >= 8
    assert all(a.hi <= b.lo for a, b in zip(files, files[1:]))  # ranges follow each other
    key = stored.filter("order_year_month_key = 202001").select("customer_key").first()[0]
    assert sum(f.lo <= key <= f.hi for f in files) <= 2


def test_unknown_measures_come_first_or_last(spark):
    m = Models(spark, SF_SMALL, BuildOptions(standin_costs=True), frozenset({"dim_customer", "fct_sales_lineitem"}))
    dim = m["dim_customer"]
    unknown = [r[0] for r in dim.select("customer_key").orderBy("customer_id").limit(3).collect()]
    fact = m["fct_sales_lineitem"].withColumn(
        "gross_margin", F.when(~F.col("customer_key").isin(unknown), F.col("gross_margin")))
    have = fact.filter(F.col("customer_key").isin(unknown)).select("customer_key").distinct().count()
    assert have
    first = [r.total_gross_margin for r in analyses.a04_top_customers_all_time(fact, dim).collect()]
    last = [r.total_gross_margin for r in analyses.a04_top_customers_all_time(fact, dim, nulls="last").collect()]
    assert first[:have] == [None] * have and None not in first[have:] and None not in last
    everyone = analyses.a05_rank_gap(fact, dim, min_gap=-1, k=10_000).collect()
    assert {r.margin_rank for r in everyone if r.total_gross_margin is None} == {1}
