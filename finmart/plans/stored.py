"""Jobs that show the store: each leaves tables whose content, read back from
the warehouse, must equal what the models give (that is how they are tested).

``built`` is a whole persisted build; ``layer_rows`` says which table lies in
which schema and with how many rows; ``snapshot_versions`` publishes three
versions and reads the newest; ``replaced_table`` writes a table over an older
state; ``stored_check_failures`` reads back the failing rows of each check;
``load_times`` looks at the load time of rows landed now; ``stale_feeds`` gives
the state of every feed of a relation.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finmart import run
from finmart.operators.scd2 import scd2_snapshot
from finmart.plans import quality
from finmart.plans.bronze import bronze
from finmart.plans.catalogue import Check
from finmart.plans.pipeline import (LAYERS, SNAPSHOT_CHECK_COLS, SNAPSHOT_COLS, SNAPSHOT_KEY,
                                    BuildOptions)
from finmart.session import scratch_path
from finmart.sources import sinks
from finmart.sources.history import customer_extracts
from finmart.sources.storage import child_names
from finmart.streaming.incremental import freshness_states

SNAPSHOT = "snap_customer_scd2"


def new_warehouse(spark: SparkSession) -> str:
    return scratch_path(spark, f"warehouse-{uuid.uuid4().hex}")


def built(spark: SparkSession, data_dir: str, options: BuildOptions) -> tuple[SparkSession, str]:
    """A persisted build in a new warehouse: the session that knows its views (one
    of its own, so no view of the caller is replaced), and the warehouse."""
    session, warehouse = spark.newSession(), new_warehouse(spark)
    run.build(session, data_dir, warehouse, options, catalog=False)
    return session, warehouse


def read_stored(spark: SparkSession, warehouse: str, name: str) -> DataFrame:
    """A table of the warehouse by the name of its model."""
    if name == SNAPSHOT:
        return sinks.read_latest_snapshot(spark, warehouse)
    return spark.read.parquet(sinks.table_path(warehouse, name))


def layer_rows(spark: SparkSession, warehouse: str) -> DataFrame:
    """(schema_name, model, n_rows) of every table that lies in the warehouse."""
    models = {m for layer in LAYERS.values() for m in layer}
    found = [(schema, name) for schema in child_names(spark, warehouse)
             for name in child_names(spark, f"{warehouse}/{schema}") if name in models - {sinks.SET_ASIDE}]
    return reduce(DataFrame.unionByName, [
        read_stored(spark, warehouse, name).agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(schema).alias("schema_name"), F.lit(name).alias("model"), "n_rows")
        for schema, name in found])


def snapshot_versions(spark: SparkSession, customer: DataFrame) -> DataFrame:
    """The history of the three customer extracts through the snapshot store: each
    run reads the open rows of the version before and publishes a new one."""
    warehouse = new_warehouse(spark)
    for as_of, extract in customer_extracts(customer.select(*SNAPSHOT_COLS)):
        before = sinks.read_latest_snapshot(spark, warehouse, open_only=True)
        sinks.write_snapshot_version(
            scd2_snapshot(before, extract, SNAPSHOT_KEY, SNAPSHOT_CHECK_COLS, as_of), warehouse, as_of)
    return sinks.read_latest_snapshot(spark, warehouse)


def replaced_table(spark: SparkSession, name: str, states: list[DataFrame]) -> DataFrame:
    """A table after it was written from each of ``states`` in turn."""
    path = sinks.table_path(new_warehouse(spark), name)
    for df in states:
        sinks.write_table(df, path)
    return spark.read.parquet(path)


def stored_check_failures(spark: SparkSession, models: dict[str, DataFrame],
                          checks: list[Check]) -> DataFrame:
    """(check_id, failures): the rows that lie in the failure store, by check."""
    warehouse = new_warehouse(spark)
    run.run_checks(spark, models, warehouse, store_failures=True, catalogue=checks)
    root = f"{warehouse}/check_failures"
    return reduce(DataFrame.unionByName, [
        spark.read.parquet(f"{root}/{folder}").agg(F.count(F.lit(1)).alias("failures"))
        .select(F.lit(int(folder.split("_")[0])).alias("check_id"), "failures")
        for folder in child_names(spark, root)])


def load_times(spark: SparkSession, sources: Callable[[str], DataFrame], tables: list[str],
               batch_id: str = "run-now") -> DataFrame:
    """Tables landed now, without a pinned time: their rows, those that carry a load
    time of this run, and whether all carry the same."""
    started = spark.range(1).select(F.localtimestamp()).first()[0]
    in_run = F.col("_ingested_at").between(F.lit(started), F.localtimestamp())
    return reduce(DataFrame.unionByName, [
        bronze(sources(t), batch_id=batch_id).agg(
            F.count(F.lit(1)).alias("n_rows"), F.count_if(in_run).alias("loaded_in_run"),
            (F.min("_ingested_at") == F.max("_ingested_at")).alias("one_load_time"),
            F.max("_batch_id").alias("batch_id"))
        .withColumn("table_name", F.lit(f"tpch_{t}")) for t in tables])


def stale_feeds(rows: DataFrame, feed: str, loaded_at: str, warn_after: int, error_after: int) -> DataFrame:
    """State of every feed of a relation twelve hours after its newest row came:
    feed, max_loaded_at, age_hours, status."""
    newest = rows.agg(F.max(F.col(loaded_at).cast("timestamp_ntz")) + F.expr("INTERVAL 12 HOURS")).first()[0]
    latest = rows.groupBy(feed).agg(F.max(F.col(loaded_at).cast("timestamp_ntz")).alias("max_loaded_at"))
    return freshness_states(latest, F.lit(newest), warn_after, error_after)
