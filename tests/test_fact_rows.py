"""What a shuffle of the fact build carries, and with how many partitions it begins."""

import re
import tempfile

from pyspark.sql import functions as F

from finmart import session
from finmart.plans.pipeline import BuildOptions, Models, build_models
from finmart.sources import sinks
from paths import SF_SMALL

FACT = "fct_sales_lineitem"


def plan_of(df) -> str:
    """The physical plan, from the top down."""
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_shuffle_carries_the_keys_of_a_line(spark):
    plan = plan_of(Models(spark, SF_SMALL, BuildOptions(standin_costs=True))[FACT])
    made = [i for i, x in enumerate(plan.splitlines()) if "AS sales_lineitem_key" in x]
    shuffles = [i for i, x in enumerate(plan.splitlines()) if "Exchange hashpartitioning" in x]
    assert made and shuffles and max(made) < min(shuffles)  # above all of them
    keys = [i for i, x in enumerate(plan.splitlines()) if re.search(r"AS (part|supplier)_key", x)]
    assert max(keys) < min(shuffles)


def test_the_frozen_fact_holds_natural_ids(spark):
    full = Models(spark, SF_SMALL, BuildOptions(standin_costs=True))[FACT]
    frozen = Models(spark, SF_SMALL, BuildOptions(standin_costs=True), frozenset({FACT}))[FACT]
    assert frozen.columns == full.columns and frozen.dtypes == full.dtypes
    stored = spark.read.parquet(*{f.rsplit("/order_year_month_key", 1)[0] for f in frozen.inputFiles()})
    assert not {"sales_lineitem_key", "part_key", "supplier_key"} & set(stored.columns)
    assert frozen.exceptAll(full).count() == 0 and full.exceptAll(frozen).count() == 0


def test_a_line_without_part_supplier_or_pair_keeps_its_row(spark):
    from finmart.plans import gold
    m = Models(spark, SF_SMALL, BuildOptions(standin_costs=True))
    lines = m["lineitem"].withColumns({
        "part_id": F.when(F.col("order_id") % 3 != 0, F.col("part_id")),
        "supplier_id": F.when(F.col("order_id") % 5 != 0, F.col("supplier_id"))})
    fact = gold.fct_sales_lineitem(lines, m["orders"], m["dim_customer"], m["partsupp"],
                                   m["dim_supplier"].filter("supplier_id % 2 = 0"),
                                   m["dim_part"].filter("part_id % 2 = 0"), m["dim_geography"])
    want = (lines.join(m["orders"].select("order_id"), "order_id")
            .join(m["dim_part"].filter("part_id % 2 = 0").select("part_id", "part_key"), "part_id", "left")
            .join(m["dim_supplier"].filter("supplier_id % 2 = 0").select("supplier_id", "supplier_key"),
                  "supplier_id", "left"))
    columns = ["order_id", "line_number", "net_revenue", "part_key", "supplier_key"]
    assert fact.select(columns).exceptAll(want.select(columns)).count() == 0
    assert want.select(columns).exceptAll(fact.select(columns)).count() == 0
    assert fact.filter("supplier_key IS NULL AND ship_geography_key IS NOT NULL").count() == 0


def test_a_build_shuffles_the_rows_before_the_keys(spark):
    plans = []

    def materialize(name, df):
        if name in (sinks.FACT_ROWS, FACT):
            plans.append((name, df))
        path = tempfile.mkdtemp(prefix="finmart-wh-")
        return sinks.table_materializer(spark, path, catalog=False)(name, df) if name == sinks.FACT_ROWS else df

    build_models(spark, SF_SMALL, BuildOptions(standin_costs=True), materialize)
    plan = plan_of(dict(plans)[FACT])
    assert "rebalance" in plan.lower() and plan.index("AS sales_lineitem_key") < plan.lower().index("rebalance")


def test_shuffles_begin_with_partitions_by_the_rows(spark):
    s = spark.newSession()
    s.conf.set("spark.sql.shuffle.partitions", "4")
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    session.size_shuffles(s, 300_000)
    assert s.conf.get(initial, None) is None  # enough as it is
    session.size_shuffles(s, 216_000_000)
    plan = s.range(10).groupBy(F.col("id") % 3).count()._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(.*, 2160\)", plan)
    session.size_shuffles(s, 1_000)
    assert s.conf.get(initial, None) is None
    s.conf.set(initial, "7")  # the session's own choice stays
    session.size_shuffles(s, 216_000_000)
    assert s.conf.get(initial) == "7"


def test_sparse_bitmaps_count_as_the_dense_ones(spark):
    from finmart.operators.distinct_bitmaps import BITS, distinct_bitmaps, distinct_counts, rolling_months
    ids = [None, 0, 1, -1, -64, -65, 63, 64, 2 ** 62, -2 ** 62, 32768]
    rows = [(g, m, i) for n, i in enumerate(ids) for g in "ab" for m in (202011, 202101) if (n + m) % 3 or g == "a"] * 2
    df = spark.createDataFrame(rows, "g string, order_year_month_key int, id bigint")
    sparse, dense = (distinct_bitmaps(df, ["g", "order_year_month_key"], "id", s) for s in (True, False))
    assert dict(sparse.dtypes)[BITS] == "bigint"  # 8 bytes where a bitmap has 4096
    for keys in (["g", "order_year_month_key"], ["g"], []):
        a, b = (distinct_counts(x, keys).select(*keys, "n_distinct").collect() for x in (sparse, dense))
        assert sorted(map(str, a)) == sorted(map(str, b))
    a, b = (sorted(map(str, rolling_months(x, ["g"], 3).collect())) for x in (sparse, dense))
    assert a == b and len(a) == 6


def test_orders_of_a_customers_month_are_no_whole_bitmap(spark):
    import __spark_entry__ as E
    plan = plan_of(E.queries()["distinct_orders_rolling"](spark, SF_SMALL))
    assert "bit_or" in plan and "bitmap_construct_agg" not in plan


def test_a_merge_keeps_no_uncompressed_copy_of_the_fact(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame
    from finmart.sources.storage import child_names
    from finmart.streaming import jobs
    taken, real = [], DataFrame.checkpoint

    def checkpoint(df, *args, **kwargs):
        taken.append(df.columns)
        return real(df, *args, **kwargs)

    m = Models(spark, SF_SMALL, BuildOptions(standin_costs=True), frozenset({"dim_customer", "partsupp"}))
    want = m[FACT]
    monkeypatch.setattr(DataFrame, "checkpoint", checkpoint)
    sales = jobs.landed_sales(spark, m)
    early = F.col("order_id") % 2 == 0
    sales.land(1, m["lineitem"], m["orders"].filter(early))
    sales.merge(1)
    sales.land(2, orders=m["orders"].filter(~early))
    fact = sales.merge(2)
    assert taken == [["order_id"]] * 2  # the orders touched, and nothing else
    assert fact.exceptAll(want).count() == 0 and want.exceptAll(fact).count() == 0
    for token in sales.merged():  # what was set aside for the write is gone
        assert "kept" not in child_names(spark, f"{sales.root}/changes/{token}")
    new = sales.change(sales.merged()[0])[1]
    assert new.columns == want.columns and new.count() == want.join(m["orders"].filter(early), "order_id").count()
    months = child_names(spark, f"{sales.root}/changes/{sales.merged()[0]}/new")
    assert any(n.startswith("order_year_month_key=") for n in months)
