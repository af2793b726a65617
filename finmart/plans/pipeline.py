"""Dependency-ordered build of every model.

Each model is one step ``(name, upstream names, fn(models) -> DataFrame)``.
``build_models`` runs the steps in order; ``materialize`` — optional — is
called with (name, DataFrame) and returns what downstream steps read:
identity for a lazy build, or "write the table, read it back" for a
persisted build (``finmart.sources.sinks.table_materializer``), which also
cuts the lineage between layers.  ``Models`` builds on first access only the
ancestors of the model asked for.
"""

from __future__ import annotations

import uuid
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from typing import Callable

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finmart.operators.asof import asof_left_join
from finmart.operators.asof_carry import asof_carry_join
from finmart.operators.scd2 import scd2_snapshot, set_aside
from finmart.plans import gold, reports, silver
from finmart.plans.bronze import BRONZE_NAMES, bronze
from finmart.sources.history import HISTORY_RUNS, customer_extracts
from finmart.sources.reader import Sources
from finmart.session import scratch_path
from finmart.sources.schemas import SOURCE_TABLES
from finmart.sources.sinks import FACT_ROWS, PRICED_LINES, SET_ASIDE, write_fact_rows, write_table

# Snapshot key and the columns whose change opens a version.
SNAPSHOT_KEY = "c_custkey"
SNAPSHOT_CHECK_COLS = ["c_mktsegment", "c_acctbal", "c_nationkey", "c_address"]
SNAPSHOT_COLS = ["c_custkey", "c_name", "c_address", "c_nationkey", "c_phone", "c_acctbal",
                 "c_mktsegment", "c_comment"]
# Snapshot time of a single-extract build (the first run of the history).
DEFAULT_AS_OF = HISTORY_RUNS[0]
# Fixed load metadata of reproducible builds.
FIXED_INGESTED_AT = "2024-01-01 00:00:00"
FIXED_BATCH_ID = "batch-0001"


@dataclass(frozen=True)
class BuildOptions:
    history: bool = False            # three-extract customer history instead of one extract
    as_of: str = DEFAULT_AS_OF       # snapshot time of a single-extract build
    calendar_start: str = gold.CALENDAR_START
    calendar_end: str | None = None  # None: derived from the data's latest date
    report_days: int = 90
    report_as_of: str | None = None  # end of the report window; None: latest order date
    standin_costs: bool = False      # made-up unit costs where partsupp is missing (test data)
    source_system: str = "TPCH_SF1"
    batch_id: str = FIXED_BATCH_ID
    ingested_at: str | None = FIXED_INGESTED_AT
    # As-of join by sorting and carrying versions forward instead of pairing a key's
    # rows and versions: for customers with very many versions.
    carry_versions: bool = False
    # Persisted builds only: the fact's files of a month hold ranges of customers.
    clustered: bool = False
    # Persisted builds only: write silver orders/lineitem bucketed by order_id.
    # Off by default — a bucketed join reads each bucket in one task, so a hot
    # order key could not be split by AQE's skew handling.
    bucketed: bool = False


Step = tuple[str, list[str], Callable[[dict], DataFrame]]


def steps(spark: SparkSession, sf_dir: str, o: BuildOptions,
          previous_snapshot: DataFrame | None = None, price_shares: int = 1) -> list[Step]:
    """The build steps.  ``previous_snapshot`` (a stored snapshot version)
    makes the snapshot step an incremental merge of the current extract.
    ``price_shares`` above 1 gives the lines with their prices as a list of so many
    frames, which ``materialize`` has to put together."""
    src = Sources(spark, sf_dir, o.standin_costs)
    out: list[Step] = []
    for t in SOURCE_TABLES:
        out.append((f"src_{t}", [], lambda m, t=t: src[t]))
        out.append((BRONZE_NAMES[t], [f"src_{t}"],
                    lambda m, t=t: bronze(m[f"src_{t}"], o.source_system, o.batch_id,
                                          o.ingested_at)))

    def snapshot(m):
        cur = m["tpch_customer"].select(*SNAPSHOT_COLS)
        if not o.history:
            return scd2_snapshot(previous_snapshot, cur, SNAPSHOT_KEY, SNAPSHOT_CHECK_COLS,
                                 o.as_of)
        snap = None
        for as_of, extract in customer_extracts(cur):
            snap = scd2_snapshot(snap, extract, SNAPSHOT_KEY, SNAPSHOT_CHECK_COLS, as_of)
        return snap

    def left_out(m):
        """The rows of every snapshot run that it can't apply."""
        cur = m["tpch_customer"].select(*SNAPSHOT_COLS)
        runs = customer_extracts(cur) if o.history else [(o.as_of, cur)]
        return reduce(DataFrame.unionByName, [
            set_aside(extract, SNAPSHOT_KEY).withColumn("snapshot_as_of", F.lit(as_of).cast("timestamp_ntz"))
            for as_of, extract in runs])

    def calendar(m):
        cover = None
        if o.calendar_end is None:
            cover = [m["orders"].select("order_date"),
                     m["lineitem"].select("ship_date", "commit_date", "receipt_date")]
        return gold.dim_date(gold.calendar_bounds(spark, o.calendar_start, o.calendar_end, cover))

    def priced(m):
        shares = gold.priced_shares(m["lineitem"], m["partsupp"], m["dim_supplier"], m["dim_part"],
                                    m["dim_geography"], price_shares)
        return shares if price_shares > 1 else shares[0]

    out += [
        ("snap_customer_scd2", ["tpch_customer"], snapshot),
        (SET_ASIDE, ["tpch_customer"], left_out),
        ("customer", ["snap_customer_scd2"], lambda m: silver.silver_customer(m["snap_customer_scd2"])),
        ("orders", ["tpch_orders"], lambda m: silver.silver_orders(m["tpch_orders"])),
        ("lineitem", ["tpch_lineitem"], lambda m: silver.silver_lineitem(m["tpch_lineitem"])),
        ("part", ["tpch_part"], lambda m: silver.silver_part(m["tpch_part"])),
        ("supplier", ["tpch_supplier"], lambda m: silver.silver_supplier(m["tpch_supplier"])),
        ("partsupp", ["tpch_partsupp"], lambda m: silver.silver_partsupp(m["tpch_partsupp"])),
        ("nation", ["tpch_nation"], lambda m: silver.silver_nation(m["tpch_nation"])),
        ("region", ["tpch_region"], lambda m: silver.silver_region(m["tpch_region"])),
        ("dim_date", ["orders", "lineitem"] if o.calendar_end is None else [], calendar),
        ("dim_geography", ["nation", "region"],
         lambda m: gold.dim_geography(m["nation"], m["region"])),
        ("dim_customer", ["customer", "nation", "region"],
         lambda m: gold.dim_customer(m["customer"], m["nation"], m["region"])),
        ("dim_supplier", ["supplier", "nation", "region"],
         lambda m: gold.dim_supplier(m["supplier"], m["nation"], m["region"])),
        ("dim_part", ["part"], lambda m: gold.dim_part(m["part"])),
        (PRICED_LINES, ["lineitem", "partsupp", "dim_supplier", "dim_part", "dim_geography"], priced),
        (FACT_ROWS, [PRICED_LINES, "orders", "dim_customer", "dim_geography"],
         lambda m: gold.fact_rows(m[PRICED_LINES], m["orders"], m["dim_customer"],
                                  m["dim_geography"],
                                  asof_carry_join if o.carry_versions else asof_left_join)),
        ("fct_sales_lineitem", [FACT_ROWS], lambda m: gold.fact_columns(m[FACT_ROWS])),
        ("rpt_customer_profitability_90d", ["fct_sales_lineitem", "dim_customer"],
         lambda m: reports.rpt_customer_profitability_90d(m["fct_sales_lineitem"],
                                                          m["dim_customer"], o.report_days,
                                                          o.report_as_of)),
        ("rpt_segment_margin_concentration", ["fct_sales_lineitem", "dim_customer"],
         lambda m: reports.rpt_segment_margin_concentration(m["fct_sales_lineitem"],
                                                            m["dim_customer"])),
    ]
    return out


LAYERS = {
    "source": [f"src_{t}" for t in SOURCE_TABLES],
    "bronze": [BRONZE_NAMES[t] for t in SOURCE_TABLES],
    "snapshot": [SET_ASIDE, "snap_customer_scd2"],
    "silver": ["customer", "orders", "lineitem", "part", "supplier", "partsupp", "nation", "region"],
    "gold": ["dim_date", "dim_geography", "dim_customer", "dim_supplier", "dim_part",
             PRICED_LINES, FACT_ROWS, "fct_sales_lineitem", "rpt_customer_profitability_90d",
             "rpt_segment_margin_concentration"],
}


def _identity(name: str, df: DataFrame) -> DataFrame:
    return df


def build_models(spark: SparkSession, sf_dir: str, options: BuildOptions | None = None,
                 materialize: Callable[[str, DataFrame], DataFrame] = _identity,
                 layer: str | None = None,
                 previous_snapshot: DataFrame | None = None, threads: int = 4,
                 price_shares: int = 1) -> dict[str, DataFrame]:
    """Build every model in dependency order (``layer`` restricts which
    models are handed to ``materialize``; upstream ones stay lazy).  Steps that
    don't need each other run at the same time, at most ``threads`` of them."""
    o = options or BuildOptions()
    selected = set(LAYERS[layer]) if layer else None
    futures: dict[str, Future] = {}

    def run(name: str, deps: list[str], fn) -> DataFrame:
        m = {d: futures[d].result() for d in deps}  # these were queued before
        df = fn(m)
        return materialize(name, df) if selected is None or name in selected else df

    with ThreadPoolExecutor(threads) as pool:
        for name, deps, fn in steps(spark, sf_dir, o, previous_snapshot, price_shares):
            futures[name] = pool.submit(inheritable_thread_target(spark)(run), name, deps, fn)
        return {name: f.result() for name, f in futures.items()}


class Models:
    """On-demand models: ``models[name]`` builds ``name`` and its ancestors
    only (a bronze query does not build the fact)."""

    def __init__(self, spark: SparkSession, sf_dir: str, options: BuildOptions | None = None,
                 freeze: frozenset[str] = frozenset()):
        """``freeze`` names models that are written once, as Parquet in the
        shared checkpoint folder, when first built: later plans start from those
        files and read only the columns and months they need.  Of the fact, the
        rows that its columns follow from are written (by month)."""
        self.spark, self.sf_dir = spark, sf_dir
        self.options = options or BuildOptions()
        self.freeze = frozenset(FACT_ROWS if n == "fct_sales_lineitem" else n for n in freeze)
        self._steps = {n: (d, f) for n, d, f in steps(spark, sf_dir, self.options)}
        self._m: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._m:
            deps, fn = self._steps[name]
            for d in deps:
                self[d]
            df = fn(self)
            self._m[name] = self._frozen(name, df) if name in self.freeze else df
        return self._m[name]

    def _frozen(self, name: str, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, f"models-{uuid.uuid4().hex}/{name}")
        (write_fact_rows if name == FACT_ROWS else write_table)(df, path)
        return self.spark.read.parquet(path).select(*df.columns)


# Models worth freezing when many queries share one lazy model set.
# (The supplier dimension is small, but only of files does Spark know that before it plans.)
SHARED_MODELS = frozenset({"snap_customer_scd2", "dim_customer", "dim_supplier", "fct_sales_lineitem"})
