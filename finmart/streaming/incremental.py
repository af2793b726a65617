"""Batch incremental patterns.

LandedSales — lines and orders land append-only in a log of hash buckets.  The
fact (partitioned by order month) follows by recomputing, from the buckets
concerned, the orders that a batch touches: its own orders and the orders of its
lines.  So a line that came before its order shows up with the order, a re-dated
order leaves its old month, and how files are dealt to batches makes no difference.

hwm_ingest — append the source rows that the target doesn't have yet, from its
high-water mark (less a lateness) on.

source_freshness — age of the latest load per table against warn/error
thresholds.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from finmart.functions.keys import year_month_key
from finmart.session import ensure_checkpoint_dir, freed_shuffles
from finmart.sources.sinks import CODEC, FACT_DICTIONARY, join_parts, month_parts
from finmart.sources.storage import child_names, delete_folder, path_exists, publish_text, read_text
from finmart.streaming.landing import BATCH, REPLACES, LandingLog
from finmart.streaming.schema_change import conform, reconcile

FACT_PARTITION = "order_year_month_key"


class LandedSales:
    """Landed silver lines and orders under ``root``, and the fact kept from them.

    Both land in a ``LandingLog`` in hash buckets of the order.  Landing is
    idempotent per batch id (a batch that runs again replaces what it landed).
    Batch ids grow with time: the latest delivery of an order wins; lines add up,
    unless a batch is landed with ``replace=True``, which stands for all lines of
    its orders delivered before.

    A merge first writes what changes (``changes/<token>``: the rows of the orders touched
    in the fact before, their rows now) and then rewrites the months concerned
    from it.  So a merge that died at any point is simply run again, and whoever
    follows the fact by its changes (``DayReport``) sees each change once.
    """

    def __init__(self, spark: SparkSession, root: str,
                 fact_for: Callable[[DataFrame, DataFrame], DataFrame],
                 fact_path: str | None = None, buckets: int = 256, policy: str = "append", land_parts: int = 1):
        """``fact_for(lines, orders)`` gives the fact rows of silver lines, dealt to
        tasks by month (else the change sets have a file per task and month);
        ``policy`` is what a change of schema means, in what lands and in the fact;
        ``land_parts``: see ``LandingLog.land``."""
        ensure_checkpoint_dir(spark)
        self.spark, self.root, self.fact_for = spark, root.rstrip("/"), fact_for
        self.fact_path = fact_path or f"{self.root}/fact"
        self.policy, self.land_parts = policy, land_parts
        needed = {"lines": ("line_number",), "orders": ("customer_id", "order_date")}
        self.logs = {name: LandingLog(spark, f"{self.root}/{name}", "order_id", buckets, policy, columns)
                     for name, columns in needed.items()}

    # ---- landing

    def land(self, batch_id: int, lines: DataFrame | None = None, orders: DataFrame | None = None,
             replace: bool = False) -> dict[str, list]:
        """What differed in the schema of the batch, by table."""
        out = {}
        for name, df in (("lines", lines), ("orders", orders)):
            if df is not None:
                with freed_shuffles(df.sparkSession):  # a stream's batches have a session of their own
                    out[name] = self.logs[name].land(batch_id, df, replace, self.land_parts)
        return out

    def _folders(self, batch_id: int) -> list[str]:
        """The landed folders of a batch; landed again, it has new ones."""
        return [t for t in (log.token(batch_id) for log in self.logs.values()) if t]

    def _state(self) -> dict:
        names = [n for n in child_names(self.spark, f"{self.root}/fact_log") if n[0] != "."]
        return (json.loads(read_text(self.spark, f"{self.root}/fact_log/{max(names)}")) if names
                else {"number": 0, "schema": None, "merged": []})

    def merged(self) -> list[str]:
        """Change sets of the merged batches, in the order of their merges."""
        return [m["token"] for m in self._state()["merged"]]

    def is_merged(self, batch_id: int) -> bool:
        done = {f for m in self._state()["merged"] for f in m["folders"]}
        return all(f in done or f.startswith("compact-") for f in self._folders(batch_id))

    def fact(self) -> DataFrame | None:
        """The fact as stored (None before the first merge)."""
        known = self._state()["schema"]
        if not known:
            return None
        schema = StructType.fromJson(known)
        if not path_exists(self.spark, self.fact_path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.fact_path).select(*schema.names)

    # ---- what a batch changes

    def _touched(self, batch_id: int) -> DataFrame | None:
        parts = [log.read(batch=batch_id) for log in self.logs.values() if batch_id in log.batches()]
        if not parts:
            return None
        return reduce(DataFrame.union, [p.select("order_id") for p in parts]).distinct().checkpoint()

    def _of(self, name: str, touched: DataFrame,
            part: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame | None:
        """All landed rows of the touched orders; only their buckets are opened, and of those
        a part (by order) is taken before the rows are shuffled."""
        log = self.logs[name]
        rows = log.read(buckets=log.buckets_of(touched))
        return None if rows is None else part(rows).join(touched, "order_id", "left_semi")

    def _parts(self, touched: DataFrame) -> list[Callable[[DataFrame], DataFrame]]:
        """Filters that split the touched orders into parts, each with up to so many lines as
        ``sinks.join_parts`` says: no more of them lie in shuffle files at once."""
        lines, orders = (log.read() for log in self.logs.values())
        if lines is None or orders is None:
            return [lambda df: df]
        share = min(1.0, touched.count() / max(1, orders.count()))
        n, kind = join_parts(math.ceil(lines.count() * share)), touched.schema["order_id"].dataType
        if n == 1:
            return [lambda df: df]
        return [lambda df, i=i: df.filter(F.pmod(F.xxhash64(F.col("order_id").cast(kind)), F.lit(n)) == i)
                for i in range(n)]

    def _prepare(self, batch_id: int, change: str) -> bool:
        """Writes the change set of a batch (False while nothing can be in the fact)."""
        touched = self._touched(batch_id)
        if touched is None:
            return False
        state, months, stored, mode = self._state(), set(), self.fact(), "overwrite"
        known = StructType.fromJson(state["schema"]) if state["schema"] else None
        for part in self._parts(touched):
            ids = part(touched)
            versions, lines = self._of("orders", ids, part), self._of("lines", ids, part)
            if versions is None or lines is None:
                return False
            # every month that a version of these orders was or is in (one row per
            # calendar month): the only folders of the fact that are read and written
            of_part = [r[0] for r in versions.select(year_month_key("order_date")).distinct().collect()]
            new = self.fact_for(current_lines(lines).drop(BATCH, REPLACES),
                                latest_orders(versions).drop(BATCH, REPLACES))
            schema, changes = reconcile(known, new.schema, self.policy, (FACT_PARTITION, "order_id"))
            old = (conform(part(stored.filter(_in_months(of_part))), schema)
                   .join(ids, "order_id", "left_semi") if stored is not None
                   else self.spark.createDataFrame([], schema))
            _by_month(old.select(*schema.names), mode).parquet(f"{change}/old")
            _by_month(conform(new, schema), mode).parquet(f"{change}/new")
            months, mode = months | set(of_part), "append"
        months = sorted(months, key=lambda m: (m is None, m))
        publish_text(self.spark, change, "ready.json", json.dumps({
            "batch": batch_id, "months": months, "schema": schema.jsonValue(),
            "changes": [c.as_dict() for c in changes]}))
        return True

    def change(self, token: str) -> tuple[DataFrame, DataFrame]:
        """The rows that a merge took from the fact, and those it put there."""
        path = f"{self.root}/changes/{token}"
        schema = StructType.fromJson(json.loads(read_text(self.spark, f"{path}/ready.json"))["schema"])
        return tuple(self.spark.read.schema(schema).parquet(f"{path}/{n}").select(*schema.names)
                     for n in ("old", "new"))

    def merge(self, batch_id: int) -> DataFrame | None:
        """Brings the fact up to date with a landed batch; the fact as stored
        (None while nothing can be in it)."""
        with freed_shuffles(self.spark):
            return self._merge(batch_id)

    def _merge(self, batch_id: int) -> DataFrame | None:
        if self.is_merged(batch_id):  # or nothing landed
            return self.fact()
        folders = self._folders(batch_id)
        token = "_".join(folders)
        path = f"{self.root}/changes/{token}"
        if not path_exists(self.spark, f"{path}/ready.json") and not self._prepare(batch_id, path):
            return self.fact()
        info = json.loads(read_text(self.spark, f"{path}/ready.json"))
        schema = StructType.fromJson(info["schema"])
        old, new = self.change(token)
        stored = self.fact()
        there = new.select(FACT_PARTITION)
        if stored is not None:
            there = there.unionByName(stored.filter(_in_months(info["months"])).select(FACT_PARTITION))
        # months of about so many rows at a time: no more of them lie twice on disk
        for months in month_parts(there):
            rows, written = new.filter(_in_months(months)), {f"{path}/new"}
            if stored is not None:
                # an order of the change set has rows of these months in it, before or after (this merge may run again)
                ids = old.select(FACT_PARTITION, "order_id").unionByName(new.select(FACT_PARTITION, "order_id"))
                kept = stored.filter(_in_months(months)).join(
                    ids.filter(_in_months(months)).select("order_id"), "order_id", "left_anti")
                # the write replaces folders that it reads from; its new rows lie in the change set
                _by_month(conform(kept, schema).hint("rebalance", FACT_PARTITION)).parquet(f"{path}/kept")
                kept = self.spark.read.schema(schema).parquet(f"{path}/kept").select(*schema.names)
                rows = kept.unionByName(rows)
                written.add(f"{path}/kept")
            # both come by month from their files: they are not shuffled again
            _by_month(rows).option("partitionOverwriteMode", "dynamic").parquet(self.fact_path)
            filled = {name for folder in written for name in child_names(self.spark, folder)}
            for name in {_month_folder(m) for m in months} - filled:  # a month that its last order has left
                delete_folder(self.spark, f"{self.fact_path}/{name}")
            delete_folder(self.spark, f"{path}/kept")
        state = self._state()
        done = {"token": token, "folders": folders, "batch": batch_id, "changes": info["changes"]}
        publish_text(self.spark, f"{self.root}/fact_log", f"{state['number'] + 1:012d}.json", json.dumps(
            {"number": state["number"] + 1, "schema": info["schema"], "merged": state["merged"] + [done]}))
        return self.fact()

    # ---- upkeep

    def compact(self) -> int:
        """Few folders instead of one per batch, for the batches before the first
        one that isn't merged; rows that later batches replace go.  The number of
        folders that went."""
        through = None
        for batch in sorted({b for log in self.logs.values() for b in log.batches()}):
            if not self.is_merged(batch):
                break
            through = batch
        if through is None:
            return 0
        return (self.logs["lines"].compact(through, current_lines)
                + self.logs["orders"].compact(through, latest_orders))

    def vacuum(self, followed: list[str] | None = None) -> None:
        """Removes landed folders that nothing names, and the change sets of merged
        batches (of those in ``followed``, if somebody follows the fact by them)."""
        for log in self.logs.values():
            log.vacuum()
        merged = self.merged()
        for token in merged if followed is None else [t for t in merged if t in set(followed)]:
            delete_folder(self.spark, f"{self.root}/changes/{token}")


def _by_month(rows: DataFrame, mode: str = "overwrite") -> DataFrameWriter:
    """A write of fact rows by month, sorted by customer, in place of what is there."""
    order = [c for c in (FACT_PARTITION, "customer_key", "order_id") if c in rows.columns]
    return (rows.sortWithinPartitions(*order).write.mode(mode).option("compression", CODEC)
                .option("parquet.dictionary.page.size", FACT_DICTIONARY).partitionBy(FACT_PARTITION))


def _in_months(months: list[int | None]) -> Column:
    """Rows of these months (None: of orders without a date)."""
    found = F.col(FACT_PARTITION).isin([m for m in months if m is not None])
    return found | F.col(FACT_PARTITION).isNull() if None in months else found


def _month_folder(month: int | None) -> str:
    return f"{FACT_PARTITION}={'__HIVE_DEFAULT_PARTITION__' if month is None else month}"


def latest_orders(versions: DataFrame) -> DataFrame:
    """The latest delivery of each order."""
    latest = versions.groupBy("order_id").agg(F.max(BATCH).alias("_latest"))
    return versions.join(latest, "order_id").filter(F.col(BATCH) == F.col("_latest")).drop("_latest")


def current_lines(lines: DataFrame) -> DataFrame:
    """Lines that no later batch replaces."""
    since = lines.filter(REPLACES).groupBy("order_id").agg(F.max(BATCH).alias("_since"))
    rows = lines.join(since, "order_id", "left")
    return rows.filter(F.col("_since").isNull() | (F.col(BATCH) >= F.col("_since"))).drop("_since")


def hwm_ingest(spark: SparkSession, source: DataFrame, target_path: str, ts_col: str,
               key: list[str] | None = None, lateness: str | None = None):
    """Append to the target the rows of ``source`` that it doesn't have.

    Looked at are the rows from the target's maximum of ``ts_col`` on, less
    ``lateness`` (an interval such as "2 days"; None: rows may be any amount
    late, the whole source is compared), and all rows without a time.  Of
    these, a row is new if the target doesn't hold it: by ``key``, or by all
    columns; a row that the source holds n times is appended until the target
    holds it n times.  Returns the mark (None on the first call).
    """
    columns = source.columns
    if not path_exists(spark, target_path):
        source.write.parquet(target_path)
        return None
    target = spark.read.parquet(target_path)
    mark = target.agg(F.max(ts_col)).first()[0]
    if mark is not None and lateness is not None:
        since = F.lit(mark) - F.expr(f"INTERVAL {lateness}")
        window = F.col(ts_col).isNull() | (F.col(ts_col) >= since)
        source, target = source.filter(window), target.filter(window)
    if key:
        same = reduce(lambda a, b: a & b, [F.col(f"s.{k}").eqNullSafe(F.col(f"t.{k}")) for k in key])
        new = source.alias("s").join(target.select(*key).distinct().alias("t"), same, "left_anti")
    else:
        new = source.exceptAll(target.select(*columns))
    new.select(*columns).checkpoint().write.mode("append").parquet(target_path)
    return mark


# Freshness thresholds of the landed sources (hours).
WARN_AFTER_HOURS = 24
ERROR_AFTER_HOURS = 48


def source_freshness(tables: dict[str, DataFrame], now: str | None = None,
                     loaded_at: str = "_ingested_at", warn_after: int = WARN_AFTER_HOURS,
                     error_after: int = ERROR_AFTER_HOURS) -> DataFrame:
    """One row per table: max_loaded_at, age_hours, status (pass/warn/error)."""
    now_col = F.lit(now).cast("timestamp_ntz") if now else F.localtimestamp()
    rows = [df.agg(F.max(loaded_at).alias("max_loaded_at"))
              .select(F.lit(name).alias("table_name"), "max_loaded_at")
            for name, df in tables.items()]
    out = reduce(DataFrame.unionByName, rows)
    return freshness_states(out, now_col, warn_after, error_after)


def freshness_states(latest: DataFrame, now: Column, warn_after: int = WARN_AFTER_HOURS,
                     error_after: int = ERROR_AFTER_HOURS) -> DataFrame:
    """Adds age_hours and status to rows with ``max_loaded_at`` (null: error)."""
    # Wall-clock difference of two timestamp_ntz values (no time zone, no DST).
    micros = F.timestamp_diff("MICROSECOND", F.col("max_loaded_at"), now)
    age = micros.cast("decimal(20,0)") / F.lit(3600 * 1_000_000).cast("decimal(12,0)")
    out = latest.withColumn("age_hours", age.cast("decimal(18,2)"))
    status = (F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
               .when(F.col("age_hours") > error_after, F.lit("error"))
               .when(F.col("age_hours") > warn_after, F.lit("warn")).otherwise(F.lit("pass")))
    return out.withColumn("status", status)
