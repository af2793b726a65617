"""The check summary on a small driver: counts are taken relation by relation, and the fact's
scratch copy has few files."""

import glob

from pyspark.sql import functions as F

import __spark_entry__ as E
from finmart.plans import quality
from finmart.plans.catalogue import CATALOGUE, Check
from finmart.session import scratch_path
from finmart.sources import faults, sinks
from paths import SF_SMALL


def test_counts_by_relation_are_those_of_the_summary(spark):
    m = E._models(spark, SF_SMALL)
    models = {"orders": faults.faulty_orders(m["orders"]), "customer": m["customer"]}
    checks = [*faults.FAULT_CHECKS, Check("customer", "customer_id", "unique"), Check("customer", "nation_id", "not_null")]
    want = {f"check_{r.check_id}": r.failures for r in quality.run_checks(models, checks).collect()}
    assert quality.count_checks(models, checks) == want and max(want.values()) > 0
    known = {"check_1": 7, "check_6": 8}
    rest = quality.count_checks(models, checks, known)
    assert rest == {k: n for k, n in want.items() if k not in known}
    summary = quality.run_checks(models, checks, observed={**rest, **known})
    assert "FileScan" not in summary._jdf.queryExecution().executedPlan().toString()
    assert {f"check_{r.check_id}": r.failures for r in summary.collect()} == {**want, **known}


def test_no_query_holds_the_checks_of_two_relations(spark, monkeypatch):
    queries, summed = [], quality._summed
    monkeypatch.setattr(quality, "_summed", lambda parts: queries.append(len(parts)) or summed(parts))
    summary = E.queries()["check_summary"](spark, SF_SMALL)
    relations = {c.relation for c in CATALOGUE}
    assert 10 < len(queries) <= len(relations) + 1 and max(queries) < 15
    assert "FileScan" not in summary._jdf.queryExecution().executedPlan().toString()
    assert summary.count() == len(CATALOGUE)


def test_the_scratch_fact_has_a_file_per_task(spark):
    there = set(glob.glob(scratch_path(spark, "models-*").removeprefix("file:")))
    rows = spark.range(4000).select((F.lit(202001) + F.col("id") % 12).cast("int").alias(sinks.MONTH), "id").repartition(3)
    stored = sinks.scratch_materializer()(sinks.FACT_ROWS, rows)
    folder, = set(glob.glob(scratch_path(spark, "models-*").removeprefix("file:"))) - there
    assert len(glob.glob(f"{folder}/**/*.parquet", recursive=True)) == 3  # 36 before
    assert stored.columns == rows.columns and sorted(stored.collect()) == sorted(rows.collect())
