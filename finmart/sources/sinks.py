"""Sinks: layered tables, views, the versioned snapshot and the check
failure store.

Layout: ``<warehouse>/<schema>/<model>`` parquet, where the schema comes
from the layer (a custom schema name is used verbatim, trimmed; otherwise
the default).  Every table write replaces the table; downstream steps read
the written table back, which cuts the lineage at each layer.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import json
import uuid
from typing import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from finmart.session import scratch_path
from finmart.sources.storage import child_names, delete_folder, publish_text, read_text

# Schema of each model.
MODEL_SCHEMA = {
    **{f"tpch_{t}": "bronze_tpch" for t in
       ("customer", "orders", "lineitem", "part", "supplier", "partsupp", "nation", "region")},
    "snap_customer_scd2": "silver_customer", "customer": "silver_customer",
    "orders": "silver_sales", "lineitem": "silver_sales",
    "part": "silver_purchasing", "supplier": "silver_purchasing", "partsupp": "silver_purchasing",
    "nation": "silver_geography", "region": "silver_geography",
    **{g: "gold_profitability" for g in
       ("dim_date", "dim_geography", "dim_customer", "dim_supplier", "dim_part",
        "fct_sales_lineitem", "rpt_customer_profitability_90d",
        "rpt_segment_margin_concentration")},
}
VIEWS = {"rpt_customer_profitability_90d", "rpt_segment_margin_concentration"}
DEFAULT_SCHEMA = "analytics"


def schema_name(custom: str | None, default: str = DEFAULT_SCHEMA) -> str:
    """Custom schema verbatim (trimmed) when set, else the default."""
    return default if custom is None else custom.strip()


def table_path(warehouse: str, name: str) -> str:
    return f"{warehouse.rstrip('/')}/{schema_name(MODEL_SCHEMA.get(name))}/{name}"


# Tables bucketed on their join key when a persisted build asks
# for it — the two largest tables meet on order_id, so bucketing both (same
# count) lets the fact join read them without shuffling either side.
BUCKETED = {"orders": "order_id", "lineitem": "order_id"}


# Fixed value: codec of the tables written.  Half of a stored fact is keys in hex, which
# zstd halves and snappy leaves as they are.
CODEC = "zstd"


def _save(w, path: str, table: str | None) -> None:
    """External catalog table at ``path`` when ``table`` is given, else a parquet folder."""
    w = w.option("compression", CODEC)
    if table:
        w.option("path", path).saveAsTable(table)
    else:
        w.parquet(path)


#: Steps on the way to the fact, no tables: the lines with cost and roles (``gold.priced_lines``),
#: and the rows that the fact's columns follow from (``gold.fact_rows``).
PRICED_LINES = "fct_priced_lines"
FACT_ROWS = "fct_rows"
MONTH = "order_year_month_key"
#: A build takes the fact's rows in parts of about so many: no more of them lie in shuffle
#: files at once.  Lines meet their prices (by part) and their orders in at most so many parts,
#: as each reads all lines.
ROWS_OF_A_PART = 2_000_000
JOIN_PARTS = 4
#: Bytes of a dictionary page of the fact: a key in hex that repeats is worth more than Spark's 1 MB.
FACT_DICTIONARY = str(8 << 20)


def spread_fact(rows: DataFrame, clustered: bool = False) -> DataFrame:
    """The fact, or the rows it follows from, dealt to write tasks by order month.

    ``rebalance`` on the month key lets AQE size the write tasks from the
    actual data — a hot month is split into several tasks, small months are
    coalesced — without the extra sampling pass a range repartition needs
    (which would compute the final join stage twice).

    ``clustered``: the files of a month hold ranges of customers that don't
    overlap, so a lookup opens one or two files of a month instead of looking into all
    of them.  The ranges need the sampling pass.
    """
    return (rows.repartitionByRange("order_year_month_key", "customer_key") if clustered
            else rows.hint("rebalance", "order_year_month_key"))


def write_fact(df: DataFrame, path: str, table: str | None = None, clustered: bool = False,
               spread: bool = True, mode: str = "overwrite") -> None:
    """Persist the fact partitioned by order month and sorted by customer.

    Rows are dealt to tasks by ``spread_fact``, unless that was done already, and
    sorted by (customer_key, order_id) inside each file so row-group statistics stay
    tight for customer lookups; the month directory prunes date filters.
    """
    w = ((spread_fact(df, clustered) if spread else df)
           .sortWithinPartitions("order_year_month_key", "customer_key", "order_id")
           .write.mode(mode).option("parquet.dictionary.page.size", FACT_DICTIONARY)
           .partitionBy("order_year_month_key"))
    _save(w, path, table)


def write_fact_rows(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A scratch copy of the rows behind the fact, by month as they come out of the
    last join: a month is a file per task, and nothing is shuffled for it."""
    _save(rows.sortWithinPartitions("order_year_month_key").write.mode(mode).partitionBy(
        "order_year_month_key"), path, None)


def join_parts(n_rows: int) -> int:
    """In how many parts so many lines meet their prices, and their orders."""
    return min(JOIN_PARTS, max(1, -(-n_rows // ROWS_OF_A_PART)))


def order_parts(rows: DataFrame, n_rows: int) -> list[DataFrame]:
    """``rows`` in parts by order, each order in one."""
    n = join_parts(n_rows)
    part = F.pmod(F.xxhash64("order_id"), F.lit(n))
    return [rows.filter(part == i) for i in range(n)] if n > 1 else [rows]


def month_parts(rows: DataFrame) -> list[list[int]]:
    """The months of ``rows``, those that follow each other together up to a part's rows."""
    parts, n = [], 0
    for month, count in rows.groupBy(MONTH).count().orderBy(MONTH).collect():  # one row a month
        if not parts or n + count > ROWS_OF_A_PART:
            parts.append([])
            n = 0
        parts[-1].append(month)
        n += count
    return parts


def write_table(df: DataFrame, path: str, table: str | None = None,
                bucket_by: str | None = None, buckets: int | None = None, mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if bucket_by and table:
        n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        w = w.bucketBy(n, bucket_by).sortBy(bucket_by)
    _save(w, path, table)


def ensure_schema(spark: SparkSession, warehouse: str, schema: str) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` at the layer's folder of the warehouse."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}` "
              f"LOCATION '{warehouse.rstrip('/')}/{schema}'")


def table_materializer(spark: SparkSession, warehouse: str, views: set[str] = VIEWS,
                       catalog: bool = True, bucketed: bool = False,
                       buckets: int | None = None, clustered: bool = False,
                       watch: Watch | None = None,
                       observed: dict | None = None) -> Callable[[str, DataFrame], DataFrame]:
    """``materialize`` hook for ``build_models``: tables are written and read
    back; views stay lazy and are registered as temp views.

    With ``catalog`` the layer schemas are databases and every model an
    external table ``<schema>.<model>`` (bucketed where ``BUCKETED`` says);
    otherwise plain parquet folders.  ``bucketed`` buckets the tables named in
    ``BUCKETED`` (opt-in: it removes the largest shuffle but gives up AQE's
    skew splitting on that join).  ``clustered``: see ``write_fact``.  ``watch`` gives
    counts over a model's rows that are taken while the model is written; they are
    put into ``observed`` by their names.

    The fact comes by way of scratch copies of its steps, which hold a fraction of what
    their shuffles do: lines with their prices, then rows by month, of which parts are
    spread and written one after the other.  What is done with is deleted, so the copies
    and the shuffle files of a step are gone when the next ones come."""
    made: set[str] = set()
    scratch = scratch_path(spark, f"build-{uuid.uuid4().hex}")
    of_rows: list[DataFrame] = []

    def stored(name: str, df: DataFrame) -> DataFrame:
        return spark.read.schema(df.schema).parquet(f"{scratch}/{name}").select(*df.columns)

    def write_months(name: str, df: DataFrame, path: str, table: str | None) -> None:
        parts = month_parts(of_rows[0])
        for k, months in enumerate(parts or [[]]):
            taken: dict = {}
            rows = df.filter(F.col(MONTH).isin(months)) if len(parts) > 1 else df
            with observation(name, rows, watch, taken) as rows:
                write_fact(rows, path, table, spread=False, mode="append" if k else "overwrite")
            for check, n in taken.items():
                observed[check] = observed.get(check, 0) + n
            for month in months:
                delete_folder(spark, f"{scratch}/{FACT_ROWS}/{MONTH}={month}")
        delete_folder(spark, scratch)

    def materialize(name: str, df: DataFrame) -> DataFrame:
        if name.startswith("src_"):
            return df
        if name == PRICED_LINES:
            shares = df if isinstance(df, list) else [df]
            for k, share in enumerate(shares):
                write_table(share, f"{scratch}/{name}", mode="append" if k else "overwrite")
            return stored(name, shares[0])
        if name in views:
            df.createOrReplaceTempView(name)
            return df
        if name == "snap_customer_scd2":
            return df  # versioned by write_snapshot_version
        if name == FACT_ROWS:
            lines = f"{scratch}/{PRICED_LINES}"
            n_lines = spark.read.parquet(lines).count() if child_names(spark, lines) else 0
            for k, part in enumerate(order_parts(df, n_lines)):
                write_fact_rows(part, f"{scratch}/{name}", "append" if k else "overwrite")
            delete_folder(spark, lines)
            of_rows.append(stored(name, df))
            return spread_fact(of_rows[0], clustered)  # before the keys are made, which no shuffle need carry
        path = table_path(warehouse, name)
        schema = schema_name(MODEL_SCHEMA.get(name))
        table = f"`{schema}`.`{name}`" if catalog else None
        if catalog and schema not in made:
            ensure_schema(spark, warehouse, schema)
            made.add(schema)
        if name == "fct_sales_lineitem":
            write_months(name, df, path, table)
        else:
            with observation(name, df, watch, observed) as rows:
                write_table(rows, path, table, BUCKETED.get(name) if bucketed else None, buckets)
        out = (spark.table(table) if catalog else spark.read.parquet(path)).select(*df.columns)
        out.createOrReplaceTempView(name)
        return out
    return materialize


#: The counts to take of a model's rows, by name of the model.
Watch = Callable[[str], list[Column]]


@contextlib.contextmanager
def observation(name: str, df: DataFrame, watch: Watch | None, observed: dict | None):
    """``df`` with the counts that ``watch`` wants; they are in ``observed`` once
    the block has written it.  (Spark counts a row again where a lost executor makes
    it write the row again: failures may then be counted too often, never too
    seldom.)"""
    wanted = watch(name) if watch else []
    if not wanted:
        yield df
        return
    taken = Observation(f"rows_of_{name}")
    yield df.observe(taken, *wanted)
    observed.update(taken.get)


def scratch_materializer(watch: Watch | None = None,
                         observed: dict | None = None) -> Callable[[str, DataFrame], DataFrame]:
    """``materialize`` hook that writes every derived model once as Parquet in the
    shared scratch folder, so later plans read the columns they need.  Of the fact, the
    rows that its columns follow from are written, a file per task with its months one
    after the other: every scan keeps its list of files on the driver, so not a file per
    task and month."""
    run = uuid.uuid4().hex

    def materialize(name: str, df: DataFrame) -> DataFrame:
        if name.startswith("src_") or name in (PRICED_LINES, "fct_sales_lineitem"):
            return df
        path = scratch_path(df.sparkSession, f"models-{run}/{name}")
        with observation(name, df, watch, observed) as rows:
            write_table(rows.sortWithinPartitions(MONTH) if name == FACT_ROWS else rows, path)
        return df.sparkSession.read.parquet(path).select(*df.columns)
    return materialize


def checkpoint_materializer(name: str, df: DataFrame) -> DataFrame:
    """``materialize`` hook that freezes every derived model once in the
    reliable checkpoint folder (raw source scans are left as they are).
    Used when a lazy build feeds many queries, e.g. a full check run: each
    model is computed once and later plans start from its files."""
    if name.startswith("src_") or name == PRICED_LINES:
        return df
    return df.checkpoint(eager=True)


# ---- snapshot store -------------------------------------------------------
#
# versions/<as_of>-<run>/state=open|closed   rows a run has written, never changed
# published/<as_of>.json                     which folders make up that version
#
# A run writes a fresh folder: the open rows as of now, and the rows it closed
# (each closed row is stored once, later versions name its folder).  The version
# exists when its manifest appears, which happens whole or not at all; a run that
# died before leaves a folder that nothing names.  Versions never overwrite.


def version_tag(as_of: str) -> str:
    """``as_of`` (a date or timestamp) as digits of fixed width, so that the
    order of the tags is the order in time."""
    return dt.datetime.fromisoformat(as_of.strip()).strftime("%Y%m%d%H%M%S%f")


def snapshot_root(warehouse: str) -> str:
    return table_path(warehouse, "snap_customer_scd2")


def snapshot_versions(spark: SparkSession, warehouse: str) -> list[str]:
    """Tags of the published versions, oldest first."""
    names = child_names(spark, f"{snapshot_root(warehouse)}/published")
    return sorted(n.removesuffix(".json") for n in names if n.endswith(".json") and n[0] != ".")


def _manifest(spark: SparkSession, warehouse: str, tag: str) -> dict:
    return json.loads(read_text(spark, f"{snapshot_root(warehouse)}/published/{tag}.json"))


def _read_folders(spark: SparkSession, warehouse: str, folders: list[str]) -> DataFrame:
    root = snapshot_root(warehouse)
    return spark.read.parquet(*[f"{root}/{f}" for f in folders])


def read_latest_snapshot(spark: SparkSession, warehouse: str,
                         open_only: bool = False) -> DataFrame | None:
    """The newest published version, or None before the first run.
    ``open_only`` reads the open rows alone (all that the next run needs)."""
    tags = snapshot_versions(spark, warehouse)
    if not tags:
        return None
    m = _manifest(spark, warehouse, tags[-1])
    return _read_folders(spark, warehouse, m["open"] + ([] if open_only else m["closed"]))


def check_snapshot_time(spark: SparkSession, warehouse: str, as_of: str) -> bool:
    """Whether a run as of this time has something to do.  A version of the
    same time is there already (a retry): nothing.  An older time is refused,
    the history can't be changed."""
    tags = snapshot_versions(spark, warehouse)
    if tags and version_tag(as_of) < tags[-1]:
        raise ValueError(f"as_of {as_of} is older than the newest snapshot version {tags[-1]}")
    return not tags or version_tag(as_of) > tags[-1]


def write_snapshot_version(df: DataFrame, warehouse: str, as_of: str) -> DataFrame:
    """Publish a version from the merge of the previous version's open rows with
    the current extract; returns the whole snapshot as stored."""
    spark, tag, root = df.sparkSession, version_tag(as_of), snapshot_root(warehouse)
    if check_snapshot_time(spark, warehouse, as_of):
        tags = snapshot_versions(spark, warehouse)
        folder = f"versions/{tag}-{uuid.uuid4().hex[:12]}"
        state = F.when(F.col("scd_valid_to").isNull(), "open").otherwise("closed")
        (df.withColumn("state", state).write.partitionBy("state").parquet(f"{root}/{folder}"))
        written = [f"{folder}/{n}" for n in child_names(spark, f"{root}/{folder}")
                   if n.startswith("state=")]
        if not written:  # an empty extract: an empty open part keeps the schema
            df.limit(0).write.parquet(f"{root}/{folder}/state=open")
            written = [f"{folder}/state=open"]
        before = _manifest(spark, warehouse, tags[-1])["closed"] if tags else []
        manifest = {"as_of": tag, "open": [f for f in written if f.endswith("open")],
                    "closed": before + [f for f in written if f.endswith("closed")]}
        publish_text(spark, f"{root}/published", f"{tag}.json", json.dumps(manifest))
    return read_latest_snapshot(spark, warehouse).select(*df.columns)


#: The model of the rows that a snapshot run can't apply.
SET_ASIDE = "snap_customer_set_aside"


def store_set_aside(rows: DataFrame, warehouse: str, as_of: str, fresh: bool = True) -> DataFrame:
    """Rows that the snapshot run of ``as_of`` leaves out, in a folder of the run;
    one that is published already (not ``fresh``) keeps what it stored."""
    path = f"{warehouse.rstrip('/')}/quarantine/{SET_ASIDE}/{version_tag(as_of)}"
    spark = rows.sparkSession
    if fresh or "_SUCCESS" not in child_names(spark, path):
        rows.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path).select(*rows.columns)


# ---- check failures -------------------------------------------------------

def store_failures(failing: DataFrame, warehouse: str, check_id: int, label: str) -> str:
    safe = "".join(ch if ch.isalnum() else "_" for ch in label)
    path = f"{warehouse.rstrip('/')}/check_failures/{check_id:03d}_{safe}"
    failing.write.mode("overwrite").parquet(path)
    return path
