"""What the fact build spares a large table: columns in shuffles, memory of tasks, bytes on disk."""

import re

from pyspark.sql import functions as F

from finmart import session
from finmart.plans.pipeline import SHARED_MODELS, BuildOptions, Models
from finmart.plans.silver import derived_amounts
from finmart.sources import sinks
from paths import SF_SMALL

FACT = "fct_sales_lineitem"
OPTIONS = BuildOptions(standin_costs=True)


def plan_lines(df) -> list[str]:
    """The physical plan, from the top down."""
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


def test_no_shuffle_carries_the_derived_amounts(spark):
    lines = plan_lines(Models(spark, SF_SMALL, OPTIONS)[FACT])
    first = min(i for i, x in enumerate(lines) if "Exchange hashpartitioning" in x)
    for amount in derived_amounts():
        made = [i for i, x in enumerate(lines) if f"AS {amount}#" in x]
        assert made and max(made) < first
    m = Models(spark, SF_SMALL, OPTIONS, SHARED_MODELS)
    stored = spark.read.parquet(*{f.rsplit("/order_year_month_key", 1)[0] for f in m[FACT].inputFiles()})
    assert not set(derived_amounts()) & set(stored.columns)
    same = ["order_id", "line_number", *derived_amounts()]
    want = m["lineitem"].join(m["orders"].select("order_id"), "order_id").select(same)
    assert m[FACT].select(same).exceptAll(want).count() == 0 == want.exceptAll(m[FACT].select(same)).count()


def test_pairs_are_not_shuffled_for_a_small_supplier_dimension(spark):
    m = Models(spark, SF_SMALL, OPTIONS, SHARED_MODELS - {FACT})
    assert not [x for x in plan_lines(m[FACT]) if re.search(r"Exchange hashpartitioning\(_supplier", x)]


def test_tasks_of_large_tables_get_few_bytes(spark):
    s = spark.newSession()
    s.conf.set("spark.sql.shuffle.partitions", "4")
    advised, scanned = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"
    before = s.conf.get(advised), s.conf.get(scanned)
    session.size_shuffles(s, 36_000_000)
    assert (s.conf.get(advised), s.conf.get(scanned)) == ("16m", "32m")
    session.size_shuffles(s, 1_000)
    assert (s.conf.get(advised), s.conf.get(scanned)) == before
    s.conf.set(advised, "7m")  # the session's own choice stays
    session.size_shuffles(s, 36_000_000)
    session.size_shuffles(s, 1_000)
    assert (s.conf.get(advised), s.conf.get(scanned)) == ("7m", before[1])


def test_tables_are_written_with_the_codec(spark, tmp_path):
    rows = spark.range(10).select("id", F.lit(202001).alias("order_year_month_key"))
    sinks.write_table(rows, f"{tmp_path}/table")
    sinks.write_fact_rows(rows, f"{tmp_path}/rows")
    for name in ("table", "rows"):
        files = spark.read.parquet(f"{tmp_path}/{name}").inputFiles()
        assert files and all(f.endswith(f".{sinks.CODEC}.parquet") for f in files)
