"""The rolling customer profitability report, kept by change.

``days``     per customer and order day: sums and counts of the fact's rows, by
             order month.  A batch takes away what its orders had in the fact and
             adds what they have now.
``totals``   per customer: the sum of the days in the report window, in hash
             buckets of the customer.  Of these, days that the moved window no
             longer holds are subtracted, days that it now holds are added, and
             so is what the batch changed in the days it keeps.

Both are immutable folders named by a manifest that appears whole or not at all
and lists the change sets applied, so each is applied once, whatever dies when.
A batch reads and writes the months and the buckets it changes and no others.

Sums go with the number of values they are of, so one without any value is NULL
as in the report; money is decimal, so what is taken away is what was added.
An order counts once for its customer and day: order ids are taken to be unique
(the model's check), as the fact's join to orders needs them to be.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finmart.functions.decimals import SUM_MONEY
from finmart.functions.keys import year_month_key
from finmart.plans.reports import MEASURES, customer_profitability
from finmart.session import ensure_checkpoint_dir, freed_shuffles
from finmart.sources.sinks import CODEC
from finmart.sources.storage import child_names, delete_folder, publish_text, read_text
from finmart.streaming.incremental import LandedSales

_COUNTS = ["orders", "lines", *[f"{m}_n" for m in MEASURES]]
_AMOUNTS = ", ".join([f"{m} decimal(38,2)" for m in MEASURES] + [f"{c} bigint" for c in _COUNTS])
_DAYS = f"customer_id bigint, order_date date, {_AMOUNTS}"
_TOTALS = f"customer_id bigint, {_AMOUNTS}"
# The report's name of each sum.
REPORT_NAMES = {"quantity": "total_quantity", "extended_price": "total_gross_revenue",
                "discount_amount": "total_discount", "net_revenue": "total_net_revenue",
                "supply_cost": "total_supply_cost", "gross_margin": "total_gross_margin"}


def _added(rows: DataFrame, *key: str) -> DataFrame:
    """Sums per key; keys whose sums and counts are all zero are gone."""
    out = rows.groupBy(*key).agg(*[F.sum(m).cast(SUM_MONEY).alias(m) for m in MEASURES],
                                 *[F.sum(c).cast("bigint").alias(c) for c in _COUNTS])
    return out.filter(" OR ".join(f"{c} <> 0" for c in [*_COUNTS, *MEASURES]))


def _signed(rows: DataFrame, sign: Column | int) -> DataFrame:
    """``rows`` of days or totals times 1 or -1."""
    sign = F.lit(sign) if isinstance(sign, int) else sign
    return rows.select(*[c for c in ("customer_id", "order_date") if c in rows.columns],
                       *[(F.col(m) * sign).cast(SUM_MONEY).alias(m) for m in MEASURES],
                       *[(F.col(c) * sign).cast("bigint").alias(c) for c in _COUNTS])


def day_sums(fact: DataFrame, dim_cust: DataFrame) -> DataFrame:
    """Sums per customer and order day; rows without a customer under NULL."""
    keys = dim_cust.select(F.col("customer_key").alias("_key"), "customer_id")
    rows = fact.select("customer_key", "order_date", "order_id", *MEASURES)
    rows = rows.join(keys, rows["customer_key"] == keys["_key"], "left")
    zero = F.lit(0).cast(SUM_MONEY)
    per_order = rows.groupBy("customer_id", "order_date", "order_id").agg(
        *[F.coalesce(F.sum(m), zero).cast(SUM_MONEY).alias(m) for m in MEASURES],
        F.count(F.lit(1)).alias("lines"), *[F.count(m).alias(f"{m}_n") for m in MEASURES])
    return _added(per_order.withColumn("orders", F.lit(1)), "customer_id", "order_date")


class DayReport:
    """The report over the fact of ``sales``, its state under ``root``.  ``as_of``
    fixes the window's end; else it is the fact's latest order date."""

    def __init__(self, spark: SparkSession, root: str, sales: LandedSales, days: int = 90,
                 as_of: str | None = None, buckets: int = 64):
        ensure_checkpoint_dir(spark)
        self.spark, self.root, self.sales = spark, root.rstrip("/"), sales
        self.window_days, self.as_of, self.buckets = days, as_of, buckets

    def state(self) -> dict:
        names = [n for n in child_names(self.spark, f"{self.root}/log") if n[0] != "."]
        if names:
            return json.loads(read_text(self.spark, f"{self.root}/log/{max(names)}"))
        return {"number": 0, "applied": [], "months": {}, "totals": {}, "window": None,
                "buckets": self.buckets}

    def _read(self, folders: list[str], schema: str) -> DataFrame:
        paths = [f"{self.root}/{f}" for f in folders]
        reader = self.spark.read.schema(schema)
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _write(self, rows: DataFrame, name: str, by: str, key: Column) -> dict[str, str]:
        """A fresh folder by ``by``; the folder of each value that has rows."""
        folder = f"{name}/{uuid.uuid4().hex[:12]}"
        (rows.withColumn(by, key).hint("rebalance", by).write.option("compression", CODEC)
             .partitionBy(by).parquet(f"{self.root}/{folder}"))
        found = child_names(self.spark, f"{self.root}/{folder}")
        return {n.split("=")[1]: f"{folder}/{n}" for n in found if n.startswith(f"{by}=")}

    def refresh(self, dim_cust: DataFrame) -> int:
        """Applies the merges of the fact that the state does not have yet; their number."""
        done = set(self.state()["applied"])
        todo = [t for t in self.sales.merged() if t not in done]
        for token in todo:
            with freed_shuffles(self.spark):
                self._apply(token, dim_cust)
        return len(todo)

    def _apply(self, token: str, dim_cust: DataFrame) -> None:
        state = self.state()
        old, new = self.sales.change(token)
        both = _signed(day_sums(old, dim_cust), -1).unionByName(_signed(day_sums(new, dim_cust), 1))
        delta = _added(both, "customer_id", "order_date").checkpoint()

        # one value per calendar month that the batch changes
        months = [str(r[0]) for r in delta.select(year_month_key("order_date")).distinct().collect()]
        before = self._read([state["months"][m] for m in months if m in state["months"]], _DAYS)
        written = self._write(_added(before.unionByName(delta), "customer_id", "order_date"), "days",
                              "order_month", year_month_key("order_date"))
        kept = {m: f for m, f in state["months"].items() if m not in months}
        after = {**kept, **written}

        window = self._window(after)
        moved = self._moved(state, window).unionByName(
            _signed(delta, 1).filter(self._within("order_date", window)))
        moved = _added(moved.filter("customer_id IS NOT NULL"), "customer_id").checkpoint()
        bucket = F.pmod(F.xxhash64("customer_id"), F.lit(state["buckets"])).cast("int")
        touched = [str(r[0]) for r in moved.select(bucket).distinct().collect()]
        totals = self._read([state["totals"][b] for b in touched if b in state["totals"]], _TOTALS)
        changed = self._write(_added(totals.unionByName(moved), "customer_id"), "totals", "bucket", bucket)
        same = {b: f for b, f in state["totals"].items() if b not in touched}
        publish_text(self.spark, f"{self.root}/log", f"{state['number'] + 1:012d}.json", json.dumps({
            "number": state["number"] + 1, "applied": state["applied"] + [token], "months": after,
            "totals": {**same, **changed}, "window": window, "buckets": state["buckets"]}))

    def _window(self, months: dict[str, str]) -> list[str] | None:
        """First and last day of the report: only the newest month is read for it."""
        end = self.as_of
        if end is None:
            if not months:
                return None
            newest = self._read([months[max(months, key=int)]], _DAYS)
            end = str(newest.agg(F.max("order_date")).first()[0])
        first = dt.date.fromisoformat(end) - dt.timedelta(days=self.window_days)
        return [str(first), end]

    @staticmethod
    def _within(day: str, window: list[str] | None) -> Column:
        if window is None:
            return F.lit(False)
        return F.col(day).between(*[F.lit(d).cast("date") for d in window])

    def _moved(self, state: dict, window: list[str] | None) -> DataFrame:
        """Days (as before the batch) that enter the window, and those that leave it."""
        if state["window"] == window:
            return self._read([], _DAYS)
        ends = [w for w in (state["window"], window) if w]
        low, high = min(w[0] for w in ends), max(w[1] for w in ends)
        span = [int(d[:4] + d[5:7]) for d in (low, high)]
        rows = self._read([f for m, f in state["months"].items() if span[0] <= int(m) <= span[1]], _DAYS)
        was, now = (self._within("order_date", w) for w in (state["window"], window))
        return _signed(rows.filter(was != now), F.when(now, 1).otherwise(-1))

    def totals(self) -> DataFrame:
        """Totals per customer in the window, as the report names them."""
        rows = self._read(list(self.state()["totals"].values()), _TOTALS)
        return rows.filter("lines > 0").select(
            "customer_id", *[F.when(F.col(f"{m}_n") != 0, F.col(m)).alias(n) for m, n in REPORT_NAMES.items()],
            F.col("orders").alias("order_count"), F.col("lines").alias("lineitem_count"))

    def report(self, dim_cust: DataFrame) -> DataFrame:
        return customer_profitability(self.totals(), dim_cust)

    def vacuum(self) -> None:
        """Removes folders and states that the newest state does not name."""
        state = self.state()
        named = {f.rsplit("/", 1)[0] for part in ("months", "totals") for f in state[part].values()}
        for part in ("days", "totals"):
            for n in child_names(self.spark, f"{self.root}/{part}"):
                if f"{part}/{n}" not in named:
                    delete_folder(self.spark, f"{self.root}/{part}/{n}")
        for n in child_names(self.spark, f"{self.root}/log"):
            if n.endswith(".json") and n != f"{state['number']:012d}.json":
                delete_folder(self.spark, f"{self.root}/log/{n}")
