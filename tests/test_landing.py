"""The landing log, changes of schema, and the report kept by change."""

import itertools
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finmart.plans import reports
from finmart.plans.pipeline import BuildOptions, Models
from finmart.streaming import jobs
from finmart.streaming.incremental import LandedSales
from finmart.streaming.landing import BATCH, LandingLog
from finmart.streaming.report_state import DayReport
from finmart.streaming.schema_change import SchemaChangeError, reconcile, wider
from paths import SF_SMALL


def folder():
    return "file://" + tempfile.mkdtemp(prefix="finmart-landing-")


def same(a, b):
    b = b.select(*a.columns)
    return a.count() == b.count() and a.exceptAll(b).count() == 0


# ---- types and policies

def test_wider_types_hold_both():
    assert wider(T.IntegerType(), T.LongType()) == T.LongType()
    assert wider(T.IntegerType(), T.DecimalType(5, 2)) == T.DecimalType(12, 2)
    assert wider(T.DecimalType(10, 2), T.DecimalType(8, 4)) == T.DecimalType(12, 4)
    assert wider(T.DecimalType(38, 0), T.DecimalType(38, 10)) is None
    assert wider(T.IntegerType(), T.DoubleType()) == T.DoubleType()
    assert wider(T.LongType(), T.DoubleType()) is None  # 53 bits don't hold it
    assert wider(T.DateType(), T.TimestampNTZType()) == T.TimestampNTZType()
    assert wider(T.StringType(), T.IntegerType()) is None
    types = [T.ByteType(), T.LongType(), T.FloatType(), T.DoubleType(), T.DecimalType(9, 2), T.DateType(),
             T.StringType(), T.NullType(), T.TimestampNTZType(), T.ArrayType(T.StringType())]
    for a, b in itertools.product(types, types):
        assert wider(a, b) == wider(b, a)
        assert wider(a, a) == a


def test_policies():
    table = T.StructType().add("id", "long").add("a", "integer").add("b", "string")
    batch = T.StructType().add("ID", "integer").add("a", "long").add("c", "date")
    want = {"ignore": {"id": "bigint", "a": "bigint", "b": "string"},
            "append": {"id": "bigint", "a": "bigint", "b": "string", "c": "date"},
            "sync": {"id": "bigint", "a": "bigint", "c": "date"}}
    for policy, columns in want.items():
        schema, changes = reconcile(table, batch, policy)
        assert {f.name: f.dataType.simpleString() for f in schema} == columns
        assert {(c.column, c.change) for c in changes} == {
            ("id", "narrower"), ("a", "widened"), ("c", "added"),
            ("b", "dropped" if policy == "sync" else "missing")}
    with pytest.raises(SchemaChangeError, match="a widened"):
        reconcile(table, batch, "fail")
    assert reconcile(table, table, "fail") == (table, [])
    with pytest.raises(SchemaChangeError, match="required"):
        reconcile(table, batch, "append", ("b",))
    with pytest.raises(SchemaChangeError, match="no type holds"):
        reconcile(table, T.StructType().add("id", "long").add("a", "string"), "append")
    with pytest.raises(ValueError, match="unknown"):
        reconcile(table, batch, "merge")


# ---- the log

def rows(spark, *ids, **columns):
    df = spark.createDataFrame([(i,) for i in ids], "order_id bigint")
    return df.withColumns({c: F.lit(v) for c, v in columns.items()}) if columns else df


def test_a_reader_opens_only_the_buckets_it_asks_for(spark):
    log = LandingLog(spark, folder(), "order_id", buckets=16)
    log.land(1, rows(spark, *range(200), v=1))
    log.land(2, rows(spark, *range(100, 300), v=2))
    touched = rows(spark, 7, 250)
    buckets = log.buckets_of(touched)
    read = log.read(buckets=buckets)
    assert 1 <= len(buckets) <= 2
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in read.inputFiles()} == set(buckets)
    got = sorted((r.order_id, r.v, r[BATCH]) for r in read.join(touched, "order_id", "left_semi").collect())
    assert got == [(7, 1, 1), (250, 2, 2)]
    assert sorted(r.order_id for r in log.read().collect()) == sorted([*range(200), *range(100, 300)])
    assert {r.order_id for r in log.read(batch=2).collect()} == set(range(100, 300))


def test_landing_again_and_dying_halfway(spark):
    root = folder()
    log = LandingLog(spark, root, "order_id", buckets=4)
    assert log.read() is None and log.batches() == []
    log.land(1, rows(spark, 1, 2))
    log.land(2, rows(spark, 3))
    first = log.token(1)
    log.land(1, rows(spark, 1, 5))  # runs again
    assert log.token(1) != first and sorted(r.order_id for r in log.read().collect()) == [1, 3, 5]
    rows(spark, 9).withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(f"{root}/data/dead")
    assert sorted(r.order_id for r in log.read().collect()) == [1, 3, 5]
    assert "data/dead" in log.vacuum() and log.vacuum() == []
    again = LandingLog(spark, root, "order_id", buckets=999)  # the number of buckets stays
    assert again.state()["buckets"] == 4 and sorted(r.order_id for r in again.read().collect()) == [1, 3, 5]
    log.land(3, rows(spark))  # an empty batch
    assert log.read(batch=3).count() == 0


def test_schemas_of_batches_meet(spark):
    log = LandingLog(spark, folder(), "order_id", buckets=4)
    log.land(1, rows(spark, 1, a=1, b="x"))
    changes = log.land(2, rows(spark, 2, c=True).withColumn("a", F.lit(5_000_000_000)))
    assert {(c.column, c.change) for c in changes} == {("a", "widened"), ("b", "missing"), ("c", "added")}
    got = {r.order_id: (r.a, r.b, r.c) for r in log.read().collect()}
    assert got == {1: (1, "x", None), 2: (5_000_000_000, None, True)}
    assert log.changes().filter("batch = 2").count() == 3
    strict = LandingLog(spark, log.root, "order_id", policy="fail")
    with pytest.raises(SchemaChangeError):
        strict.land(3, rows(spark, 3))
    assert log.batches() == [1, 2]
    gone = LandingLog(spark, log.root, "order_id", policy="sync")
    gone.land(3, rows(spark, 3, a=1))
    assert gone.schema().names == ["order_id", "a"] and gone.read().count() == 3


def test_compaction_keeps_the_rows(spark):
    log = LandingLog(spark, folder(), "order_id", buckets=4)
    for i in range(6):
        log.land(i, rows(spark, i, i + 1, **({"late": i} if i > 2 else {})))
    before = log.read().checkpoint()
    assert log.compact(3) == 4 and len(log.state()["folders"]) == 3
    assert same(log.read(), before)
    assert log.read(batch=2).count() == 2
    with pytest.raises(ValueError, match="compacted"):
        log.land(2, rows(spark, 9))
    log.land(4, rows(spark, 9))
    log.vacuum()
    assert log.read().count() == before.count() - 1


# ---- the fact

def fact_of(lines, orders):
    """A small fact that carries whatever columns the lines have."""
    dates = orders.select("order_id", F.col("order_date").cast("date").alias("order_date"), "customer_id")
    return lines.join(dates, "order_id").withColumn(
        "order_year_month_key", F.year("order_date") * 100 + F.month("order_date"))


def orders_of(spark, *pairs):
    return spark.createDataFrame([(i, 1, d) for i, d in pairs], "order_id bigint, customer_id bigint, order_date string")


def test_a_column_of_a_later_batch_joins_the_fact(spark):
    for policy in ("append", "ignore", "sync"):
        sales = LandedSales(spark, folder(), fact_of, buckets=4, policy=policy)
        sales.land(1, rows(spark, 1, 2, line_number=1, old="x"), orders_of(spark, (1, "2020-01-05"), (2, "2020-02-05")))
        assert sales.merge(1).count() == 2
        sales.land(2, rows(spark, 3, line_number=5_000_000_000, promo="p"), orders_of(spark, (3, "2020-02-07")))
        fact = sales.merge(2)
        got = {r.order_id: r.asDict() for r in fact.collect()}
        assert set(got) == {1, 2, 3} and got[3]["line_number"] == 5_000_000_000 and got[1]["line_number"] == 1
        assert ("promo" in fact.columns, "old" in fact.columns) == {
            "append": (True, True), "ignore": (False, True), "sync": (True, False)}[policy]
        if policy == "append":
            assert (got[3]["promo"], got[1]["promo"], got[1]["old"], got[3]["old"]) == ("p", None, "x", None)
    sales = LandedSales(spark, folder(), fact_of, buckets=4, policy="fail")
    sales.land(1, rows(spark, 1, line_number=1), orders_of(spark, (1, "2020-01-05")))
    sales.merge(1)
    with pytest.raises(SchemaChangeError):
        sales.land(2, rows(spark, 2, line_number=1, promo="p"))
    with pytest.raises(SchemaChangeError):  # whatever the policy
        LandedSales(spark, folder(), fact_of).land(1, rows(spark, 1))
    assert sales.fact().count() == 1


def test_a_merge_opens_touched_buckets_and_can_die_anywhere(spark):
    sales = LandedSales(spark, folder(), fact_of, buckets=32)
    sales.land(1, rows(spark, *range(300), line_number=1), orders_of(spark, *[(i, f"2020-0{1 + i % 6}-11") for i in range(300)]))
    sales.merge(1)
    sales.land(2, rows(spark, 7, line_number=2), orders_of(spark, (8, "2020-09-09")))
    touched = sales._touched(2)
    for name in ("lines", "orders"):
        opened = {f.split("bucket=")[1].split("/")[0] for f in sales._of(name, touched).inputFiles()}
        assert 1 <= len(opened) <= 2
    # the change set is there, one month is rewritten already, and the merge dies
    path = f"{sales.root}/changes/" + "_".join(sales._folders(2))
    assert sales._prepare(2, path)
    new = spark.read.parquet(f"{path}/new").filter("order_id = 8").checkpoint()
    new.write.mode("append").partitionBy("order_year_month_key").parquet(sales.fact_path)
    fact = sales.merge(2)
    got = sorted((r.order_id, r.line_number, str(r.order_date)) for r in fact.filter("order_id IN (7, 8)").collect())
    assert got == [(7, 1, "2020-02-11"), (7, 2, "2020-02-11"), (8, 1, "2020-09-09")]
    assert fact.count() == 301
    old, new = sales.change(sales.merged()[-1])
    assert (old.count(), new.count()) == (2, 3)
    assert sales.merge(2).count() == 301 and len(sales.merged()) == 2  # nothing to do


def test_compacted_sales_go_on(spark):
    sales = LandedSales(spark, folder(), fact_of, buckets=4)
    for i in range(1, 5):
        sales.land(i, rows(spark, 1, i + 10, line_number=i), orders_of(spark, (1, f"2020-0{i}-01"), (i + 10, "2020-05-05")),
                   replace=i == 3)
        if i < 4:
            sales.merge(i)
    assert sales.compact() == 6  # batch 4 isn't merged yet
    assert sales.logs["orders"].read().filter("order_id = 1").count() == 2  # one of them from batch 4
    fact = sales.merge(4)
    assert sorted((r.line_number, str(r.order_date)) for r in fact.filter("order_id = 1").collect()) == [
        (3, "2020-04-01"), (4, "2020-04-01")]
    total = fact.count()
    sales.land(5, orders=orders_of(spark, (1, "2020-07-01")))
    assert sales.merge(5).filter("order_year_month_key = 202007").count() == 2
    assert sales.compact() > 0 and sales.merge(2).count() == total
    sales.vacuum()
    assert sales.merge(5).count() == total


# ---- the report

@pytest.fixture(scope="module")
def models(spark):
    return Models(spark, SF_SMALL, BuildOptions(history=True, standin_costs=True),
                  frozenset({"dim_customer", "orders", "lineitem", "partsupp"}))


def test_report_by_change_equals_the_report_after_every_batch(spark, models):
    dim = models["dim_customer"]
    costs = models["partsupp"].filter("(part_id + supplier_id) % 3 <> 0")  # some costs are unknown

    def fact_for(lines, orders):
        from finmart.plans import gold
        return gold.fct_sales_lineitem(lines, orders, dim, costs, models["dim_supplier"], models["dim_part"],
                                       models["dim_geography"])

    sales = LandedSales(spark, folder(), fact_for, buckets=8)
    kept = DayReport(spark, folder(), sales, buckets=4)
    fixed = DayReport(spark, folder(), sales, days=400, as_of="1999-06-30", buckets=4)
    ends = []

    def check(batch):
        for report, args in ((kept, {}), (fixed, {"days": 400, "as_of": "1999-06-30"})):
            assert report.refresh(dim) == 1 and report.refresh(dim) == 0
            want = reports.rpt_customer_profitability_90d(sales.fact(), dim, **args)
            assert same(report.report(dim), want)
        ends.append(kept.state()["window"][1])
        assert kept.report(dim).count() > 5

    jobs.changed_sales(spark, models, sales, check)
    assert len(set(ends)) > 1  # the window has moved
    kept.vacuum()
    # the newest orders turn out to be old ones: the window goes back
    last = models["orders"].filter(F.col("order_date") >= F.lit(ends[-1]).cast("date") - F.expr("INTERVAL 20 DAY"))
    sales.land(9, orders=last.withColumn("order_date", F.date_sub("order_date", 900)))
    sales.merge(9)
    check(9)
    assert ends[-1] < ends[-2]


def test_schema_change_job_equals_a_rebuild(spark):
    m = Models(spark, SF_SMALL, BuildOptions(standin_costs=True))
    full = m["fct_sales_lineitem"].checkpoint()
    fact = jobs.schema_change(spark, m)
    assert dict(fact.dtypes)["line_number"] == "bigint"
    assert same(fact.select(*full.columns), full)


def test_the_command_lands_batches(spark, capsys):
    import json
    from finmart import land, run
    wh, source = tempfile.mkdtemp(prefix="finmart-wh-"), tempfile.mkdtemp(prefix="finmart-in-")
    built = run.build(spark, SF_SMALL, wh, BuildOptions(standin_costs=True))
    tables = {t: spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("orders", "lineitem")}
    key = {"orders": F.col("o_orderkey"), "lineitem": F.col("l_orderkey")}
    for batch, parts in ((1, {"orders": 0, "lineitem": 0}), (2, {"lineitem": 1}), (3, {"orders": 1})):
        for t, rest in parts.items():
            tables[t].filter(key[t] % 2 == rest).write.parquet(f"{source}/{batch}/{t}.parquet")
        argv = ["--batch", f"{source}/{batch}", "--batch-id", str(batch), "--warehouse", wh, "--buckets", "4"]
        land.main(argv + (["--compact"] if batch == 3 else []))
        out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
        assert out["landed"] == sorted({"orders": "orders", "lineitem": "lines"}[t] for t in parts)
    assert out["folders_compacted"] > 0
    sales, report, dim = land.warehouse_sales(spark, wh)
    full = built["fct_sales_lineitem"]
    assert same(sales.fact().select(*full.columns), full)
    assert same(spark.read.parquet(f"{sales.root}/rpt_customer_profitability_90d"),
                reports.rpt_customer_profitability_90d(full, dim))
    with pytest.raises(FileNotFoundError):
        land.land_batch(spark, source, 4, wh)
