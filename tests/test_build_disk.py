"""What a persisted build holds on disk while it runs: no shuffle files of finished steps, and
shuffle files of only a part of the fact's rows at a time."""

import glob

import pytest
from pyspark.sql import functions as F

from finmart import run, session
from finmart.plans import gold, quality
from finmart.plans.pipeline import BuildOptions, Models
from finmart.sources import sinks
from paths import SF_SMALL

FACT = "fct_sales_lineitem"
OPTIONS = BuildOptions(standin_costs=True)
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark) -> set[str]:
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in folders for f in glob.glob(f"{d.getPath()}/*/shuffle_*.data")}


def shuffled(spark, path: str) -> set[str]:
    before = shuffle_files(spark)
    spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().write.parquet(path)
    return shuffle_files(spark) - before


def test_shuffle_files_go_with_their_query(spark, tmp_path):
    assert shuffled(spark, f"{tmp_path}/kept")
    with session.freed_shuffles(spark):
        assert not shuffled(spark, f"{tmp_path}/freed")
    assert spark.conf.get(CLEANUP, None) is None


def test_a_session_keeps_its_own_choice(spark, tmp_path):
    s = spark.newSession()
    s.conf.set(CLEANUP, "false")
    with session.freed_shuffles(s):
        assert shuffled(s, f"{tmp_path}/kept")
    assert s.conf.get(CLEANUP) == "false"


@pytest.fixture(scope="module")
def built_in_parts(spark, tmp_path_factory):
    """A build whose parts are small: (models, counts of checks, rows of each part written,
    shuffle files and steps that are left)."""
    written, observed, scratch = [], {}, session.scratch_path(spark, "build-*").removeprefix("file:")
    session_, before, there = spark.newSession(), shuffle_files(spark), set(glob.glob(scratch))
    patch, write = pytest.MonkeyPatch(), sinks.write_fact

    def logged(df, path, *args, **kwargs):
        written.append((df.count(), df.inputFiles()))
        write(df, path, *args, **kwargs)

    patch.setattr(sinks, "ROWS_OF_A_PART", 900)
    patch.setattr(sinks, "write_fact", logged)
    try:
        models = run.build(session_, SF_SMALL, str(tmp_path_factory.mktemp("wh")), OPTIONS, observed=observed,
                           catalog=False)
    finally:
        patch.undo()
    return models, observed, written, shuffle_files(spark) - before, set(glob.glob(scratch)) - there


def test_a_build_in_parts_stores_the_same_fact(spark, built_in_parts):
    models, observed, written, _, _ = built_in_parts
    want, got = Models(spark, SF_SMALL, OPTIONS)[FACT].toPandas(), models[FACT].toPandas()
    key = ["order_id", "line_number", "sales_lineitem_key", "net_revenue"]
    for x in (want, got):
        x.sort_values(key, inplace=True, ignore_index=True)
    assert len(got) and got.equals(want[got.columns])
    assert len(written) > 2 and sum(n for n, _ in written) == len(got)
    per_month = got.groupby("order_year_month_key").size().max()
    assert all(n <= max(900, per_month) for n, _ in written)
    with_scan = quality.run_checks(models).collect()
    assert sorted(quality.run_checks(models, observed=observed).collect()) == sorted(with_scan)


def test_a_build_leaves_neither_shuffle_files_nor_steps(built_in_parts):
    models, _, _, shuffles, steps = built_in_parts
    assert not shuffles and not steps
    assert not {sinks.PRICED_LINES, sinks.FACT_ROWS} & set(models)


def test_a_part_reads_its_months_only(spark, tmp_path):
    m = Models(spark, SF_SMALL, OPTIONS)
    materialize = sinks.table_materializer(spark, str(tmp_path), catalog=False)
    rows = materialize(sinks.FACT_ROWS, m[sinks.FACT_ROWS])
    month = rows.agg(F.min(sinks.MONTH)).first()[0]
    plan = rows.filter(F.col(sinks.MONTH).isin([month]))._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({sinks.MONTH}" in plan and f"= {month})" in plan


def test_each_order_is_in_one_part(spark):
    rows = spark.range(5000).select((F.col("id") / 3).cast("long").alias("order_id"))
    parts = sinks.order_parts(rows, 10 * sinks.ROWS_OF_A_PART)
    assert len(parts) == sinks.JOIN_PARTS and sum(p.count() for p in parts) == 5000
    orders = [{r.order_id for r in p.collect()} for p in parts]
    assert sum(map(len, orders)) == len(set.union(*orders))
    assert len(sinks.order_parts(rows, 5000)) == 1


def test_lines_meet_their_prices_in_shares(spark):
    m = Models(spark, SF_SMALL, OPTIONS)
    lines = m["lineitem"].withColumns({c: F.when(F.col("line_number") != n, F.col(c)) for c, n in (
        ("part_id", 2), ("supplier_id", 3))})
    rest = [m[t] for t in ("partsupp", "dim_supplier", "dim_part", "dim_geography")]
    rest[2] = rest[2].filter("part_id % 5 <> 0")  # parts that the dimension lacks
    want = gold.priced_lines(lines, *rest).collect()
    shares = [s.collect() for s in gold.priced_shares(lines, *rest, 3)]
    assert len(shares) == 3 and all(0 < len(s) < len(want) / 2 for s in shares)
    parts = [{r.part_id for r in s} - {None} for s in shares]
    assert sum(map(len, parts)) == len(set.union(*parts))
    assert sorted(map(repr, sum(shares, []))) == sorted(map(repr, want))


def test_a_build_prices_a_share_at_a_time(spark, tmp_path, monkeypatch):
    written, write = [], sinks.write_table

    def logged(df, path, *args, **kwargs):
        if path.endswith(sinks.PRICED_LINES):
            written.append(df.count())
        write(df, path, *args, **kwargs)

    monkeypatch.setattr(sinks, "ROWS_OF_A_PART", 900)
    monkeypatch.setattr(sinks, "write_table", logged)
    models = run.build(spark.newSession(), SF_SMALL, str(tmp_path), OPTIONS, catalog=False)
    assert len(written) == sinks.JOIN_PARTS and sum(written) == models["lineitem"].count()
