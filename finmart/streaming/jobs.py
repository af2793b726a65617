"""Maintenance jobs built from the incremental/streaming patterns.

Each job leaves a table whose content must equal a full rebuild — that is how
they are tested: ``incremental_fact`` (initial load, then a batch that
delivers part of a month again), ``redated_order`` and ``late_order`` (orders
that change month, or come after their lines), ``schema_change`` (batches with
added, missing and widened columns), ``report_by_change`` (the 90-day report kept
from what each batch changes), ``orders_from_changes`` (a change log in batches of
any order), ``late_extracts`` (snapshot extracts in any order), ``orders_hwm`` (high-water-mark
loads with ties, late rows and rows without a time), ``orders_stream``
(file-stream landing), ``report_refresh`` (a stream over lineitem files keeping
the fact and the 90-day report current).
"""

from __future__ import annotations

import math
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finmart.functions.metadata import META_COLUMNS
from finmart.plans import gold, silver
from finmart.plans.bronze import bronze
from finmart.session import freed_shuffles, scratch_path
from finmart.sources.history import customer_extracts
from finmart.sources.reader import align_source
from finmart.sources.sinks import JOIN_PARTS, join_parts, spread_fact, write_table
from finmart.streaming.change_log import ChangeTable
from finmart.streaming.incremental import LandedSales, hwm_ingest
from finmart.streaming.landing import LandingLog
from finmart.streaming.late_snapshots import LateSnapshots
from finmart.streaming.new_row_checks import NewRowRelationships, NewRowUnique
from finmart.streaming.report_state import DayReport
from finmart.streaming.stream import STREAM_BATCH_COL, refresh_on_new_lines, stream_ingest


def _scratch(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:8]}")


def fact_for_lines(models, costs: DataFrame, lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Fact rows for a set of silver lineitem rows, against the current dims."""
    return gold.fct_sales_lineitem(lines, orders, models["dim_customer"],
                                   costs, models["dim_supplier"], models["dim_part"],
                                   models["dim_geography"], spread=spread_fact)


#: Orders that one bucket of the landing log is meant for.
ORDERS_PER_BUCKET = 100_000


def landed_sales(spark: SparkSession, models, root: str | None = None, **options) -> LandedSales:
    """Every part of a merge meets the unit costs, so these are written once.  The buckets are a
    multiple of the parts: a part then opens its own ones only."""
    buckets = max(8, math.ceil(models["orders"].count() / ORDERS_PER_BUCKET))
    options.setdefault("buckets", math.ceil(buckets / JOIN_PARTS) * JOIN_PARTS)
    options.setdefault("land_parts", join_parts(models["lineitem"].count()))
    path = _scratch(spark, "costs")
    with freed_shuffles(spark):
        write_table(models["partsupp"], path)
    costs = spark.read.parquet(path)
    return LandedSales(spark, root or _scratch(spark, "sales"),
                       lambda lines, orders: fact_for_lines(models, costs, lines, orders), **options)


def merged(sales: LandedSales, batch_id: int) -> DataFrame:
    """The fact after the merge of a batch; nobody follows it, so the change set goes."""
    fact = sales.merge(batch_id)
    sales.vacuum()
    return fact


def incremental_fact(spark: SparkSession, models, split: str = "2001-01-15",
                     overlap_from: str = "2001-01-01") -> DataFrame:
    """Initial load of the lines of orders before ``split``, then a batch that
    delivers the lines of orders from ``overlap_from`` on, part of them again.
    The result is the whole fact."""
    sales = landed_sales(spark, models)
    dates = models["orders"].select("order_id", "order_date")
    lines = models["lineitem"].join(dates, "order_id")
    sales.land(1, lines.filter(F.col("order_date") < F.lit(split).cast("date")).drop("order_date"),
               models["orders"])
    merged(sales, 1)
    late = lines.filter(F.col("order_date") >= F.lit(overlap_from).cast("date")).drop("order_date")
    sales.land(2, late, replace=True)
    return merged(sales, 2)


def redated_order(spark: SparkSession, models) -> DataFrame:
    """Every fifth order is first delivered with a date 45 days off and then
    with its own; its lines must leave the month they were in."""
    sales = landed_sales(spark, models)
    orders = models["orders"]
    moved = F.col("order_id") % 5 == 0
    sales.land(1, models["lineitem"], orders.withColumn(
        "order_date", F.when(moved, F.date_add("order_date", 45)).otherwise(F.col("order_date"))))
    merged(sales, 1)
    sales.land(2, orders=orders.filter(moved))
    return merged(sales, 2)


def late_order(spark: SparkSession, models) -> DataFrame:
    """All lines arrive with half of the orders; the other half comes later,
    without any new lines."""
    sales = landed_sales(spark, models)
    early = F.col("order_id") % 2 == 0
    sales.land(1, models["lineitem"], models["orders"].filter(early))
    merged(sales, 1)
    sales.land(2, orders=models["orders"].filter(~early))
    return merged(sales, 2)


def schema_change(spark: SparkSession, models, policy: str = "append") -> DataFrame:
    """Three batches of different schema: the first with small types, the second
    without a column and with a new one, the third with wider types, in which part
    of the first is delivered again.  The result is the whole fact."""
    sales = landed_sales(spark, models, policy=policy)
    third = F.pmod(F.col("order_id"), F.lit(3))
    lines, orders = models["lineitem"], models["orders"]
    small = lines.withColumn("line_number", F.col("line_number").cast("smallint"))
    sales.land(1, small.filter(third == 0), orders.filter(third == 0).drop("order_comment"))
    merged(sales, 1)
    sales.land(2, lines.filter(third == 1).drop("line_comment").withColumn("promotion", F.lit("none")),
               orders.filter(third == 1).withColumn("channel", F.lit("web")))
    merged(sales, 2)
    wide = lines.filter((third == 2) | (F.col("order_id") % 6 == 0)).withColumns({
        "line_number": F.col("line_number").cast("bigint"), "quantity": F.col("quantity").cast("decimal(14,3)")})
    sales.land(3, wide, orders.filter(third == 2), replace=True)
    return merged(sales, 3)


def changed_sales(spark: SparkSession, models, sales: LandedSales, after_batch=None) -> None:
    """The source in three batches that end in the whole of it: early orders, some
    with a date 45 days off and some with doubled lines; later orders but every
    seventh; then the late orders and what was wrong."""
    lines, orders = models["lineitem"], models["orders"]
    # one value for all batches: an approximate one may come out differently when it is taken again
    split = orders.select(F.percentile_approx(F.unix_date("order_date"), 0.97)).first()[0]
    early = F.unix_date("order_date") < F.lit(split)
    off, doubled, late = F.col("order_id") % 5 == 0, F.col("order_id") % 6 == 0, F.col("order_id") % 7 == 0
    dates = orders.select("order_id", early.alias("early"))
    early_lines = lines.join(dates, "order_id").filter("early").drop("early")
    late_lines = lines.join(dates, "order_id").filter("NOT early").drop("early")
    wrong = early_lines.filter(doubled).withColumn("quantity", (F.col("quantity") * 2).cast("decimal(10,2)"))
    moved = F.when(off, F.date_add("order_date", 45)).otherwise(F.col("order_date"))
    batches = [
        dict(lines=early_lines.filter(~doubled).unionByName(wrong),
             orders=orders.filter(early).withColumn("order_date", moved)),
        dict(lines=late_lines, orders=orders.filter(~early & ~late)),
        dict(lines=early_lines.filter(doubled), replace=True,
             orders=orders.filter((early & off) | (~early & late))),
    ]
    for i, batch in enumerate(batches):
        sales.land(i + 1, **batch)
        sales.merge(i + 1)
        if after_batch:
            after_batch(i + 1)


def report_by_change(spark: SparkSession, models, days: int = 90) -> DataFrame:
    """The 90-day report after three batches, from what each of them changed."""
    sales = landed_sales(spark, models)
    report = DayReport(spark, _scratch(spark, "rpt90-days"), sales, days)
    changed_sales(spark, models, sales, lambda _: followed(sales, report, models["dim_customer"]))
    return report.report(models["dim_customer"])


def followed(sales: LandedSales, report: DayReport, dim_customer: DataFrame) -> None:
    """Brings the report up to date with the fact; what it needs no more goes."""
    report.refresh(dim_customer)
    sales.vacuum(followed=report.state()["applied"])
    report.vacuum()


def order_changes(orders: DataFrame) -> DataFrame:
    """A change log that ends in the orders without every seventh: each order comes
    with a wrong price and status, which updates set right; every fifth is deleted
    and inserted anew, with a priority that an update sets right; every seventh is
    deleted in the end."""
    none = F.lit(None).cast("array<string>")
    wrong = {"o_totalprice": F.lit(0.0), "o_orderstatus": F.lit("X")}
    fifth, seventh = F.col("o_orderkey") % 5 == 0, F.col("o_orderkey") % 7 == 0
    steps = [
        ("I", None, orders.withColumns(wrong)),
        ("U", ["o_totalprice"], orders.withColumn("o_orderstatus", F.lit("?"))),
        ("U", ["o_orderstatus"], orders.withColumn("o_totalprice", F.lit(-1.0))),
        ("D", None, orders.filter(fifth).withColumns(wrong)),
        ("I", None, orders.filter(fifth).withColumn("o_orderpriority", F.lit("NEW"))),
        ("U", ["o_orderpriority"], orders.filter(fifth).withColumns(wrong)),
        ("D", None, orders.filter(seventh)),
    ]
    logs = [rows.select(F.lit(op).alias("op"), (F.col("o_orderkey") * 10 + i).alias("seq"),
                        (F.array(*map(F.lit, changed)) if changed else none).alias("changed"), *orders.columns)
            for i, (op, changed, rows) in enumerate(steps)]
    return reduce(DataFrame.unionByName, logs)


def orders_from_changes(spark: SparkSession, sf_dir: str, batches: int = 3) -> DataFrame:
    """The orders from their change log, dealt to batches without regard to its
    order; every eighth change comes again in the last batch."""
    log = order_changes(spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet"))
    table = ChangeTable(spark, _scratch(spark, "orders-changes"), ["o_orderkey"], buckets=8)
    dealt = F.pmod(F.xxhash64("seq"), F.lit(batches))
    for i in range(batches):
        again = F.pmod(F.xxhash64("seq", F.lit(1)), F.lit(8)) == 0 if i == batches - 1 else F.lit(False)
        table.apply(log.filter((dealt == i) | again))
    return table.rows()


def late_extracts(spark: SparkSession, customer: DataFrame, key: str, check_cols: list[str],
                  order: tuple[int, ...] = (2, 0, 1)) -> DataFrame:
    """The history of the three customer extracts, which arrive in this order."""
    runs = customer_extracts(customer)
    snapshots = LateSnapshots(spark, _scratch(spark, "late-snapshots"), key, check_cols)
    for i in order:
        as_of, extract = runs[i]
        snapshots.apply(extract, as_of)
    return snapshots.history()


def new_row_checks(spark: SparkSession, orders: DataFrame, customers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Orders that occur more than once (unique_field, n_records) and customers that
    are missing (value, n), checked while both land in three batches; copies of an
    order come in another batch than the order, customers after some of their orders."""
    logs = {n: LandingLog(spark, _scratch(spark, n), k, buckets=8)
            for n, k in (("orders", "order_id"), ("customers", "customer_id"))}
    count = orders.groupBy("order_id").agg(F.count(F.lit(1)).alias("_n"))
    rows = orders.distinct().join(count, "order_id").withColumn(
        "_copy", F.explode(F.sequence(F.lit(0), F.col("_n").cast("int") - 1))).drop("_n")
    expected = orders.count()
    unique = NewRowUnique(spark, _scratch(spark, "unique"), logs["orders"], ["order_id"], expected)
    related = NewRowRelationships(spark, _scratch(spark, "related"), logs["orders"], "customer_id",
                                  logs["customers"], "customer_id")
    for i in range(3):
        logs["orders"].land(i, rows.filter(F.pmod(F.col("order_id") + F.col("_copy"), F.lit(3)) == i).drop("_copy"))
        logs["customers"].land(i, customers.select("customer_id").filter(F.pmod("customer_id", F.lit(3)) == i))
        unique.follow(i)
        related.follow(i)
    return (unique.failures().select(F.col("order_id").alias("unique_field"), "n_records"),
            related.failures())


def orders_hwm(spark: SparkSession, sf_dir: str, ts_col: str = "o_orderdate",
               split_fraction: float = 0.5, late: bool = False) -> DataFrame:
    """High-water-mark loads of the orders source: the first up to a cut derived
    from the data's own date range, the second picks up the rest.  With
    ``late`` the first load also misses every seventh row (they come late, or
    tie with the mark), and every eleventh row has no time."""
    orders = spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet")
    lo, hi = orders.agg(F.min(ts_col), F.max(ts_col)).first()
    cut = lo + (hi - lo) * split_fraction if lo is not None else None
    target = _scratch(spark, "orders-hwm")
    if late:
        orders = orders.withColumn(ts_col, F.when(F.col("o_orderkey") % 11 != 0, F.col(ts_col)))
    first = orders.filter(F.col(ts_col) <= F.lit(cut)) if cut else orders
    hwm_ingest(spark, first.filter("o_orderkey % 7 <> 0") if late else first, target, ts_col)
    hwm_ingest(spark, orders, target, ts_col)
    return spark.read.parquet(target).select(*orders.columns)


def orders_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the orders source through a file-stream query (availableNow)."""
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet").schema
    target, ckpt = _scratch(spark, "orders-stream"), _scratch(spark, "orders-stream-ckpt")
    stream_ingest(spark, sf_dir, "orders.parquet", schema, target, ckpt)
    return spark.read.parquet(target).drop(*META_COLUMNS, STREAM_BATCH_COL)


def report_refresh(spark: SparkSession, models, sf_dir: str, days: int = 90,
                   max_files: int | None = None) -> DataFrame:
    """Keep the fact and the 90-day report current from a lineitem file stream."""
    sales = landed_sales(spark, models)
    report = DayReport(spark, _scratch(spark, "rpt90-stream"), sales, days)
    ckpt = _scratch(spark, "rpt90-stream-ckpt")
    o = models.options
    sales.land(0, orders=models["orders"])

    def on_batch(batch: DataFrame, batch_id: int):
        raw = align_source(batch, "lineitem")
        lines = silver.silver_lineitem(bronze(raw, o.source_system, f"stream-{batch_id}",
                                              o.ingested_at))
        sales.land(batch_id + 1, lines)
        sales.merge(batch_id + 1)
        followed(sales, report, models["dim_customer"])

    refresh_on_new_lines(spark, sf_dir, ckpt, on_batch, pattern="lineitem.parquet",
                         max_files=max_files)
    return report.report(models["dim_customer"])
