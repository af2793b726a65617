"""Uniqueness and relationships checked on new rows only.

``NewRowUnique`` follows a landing log.  Of a new batch, keys that occur twice in it
and keys that the stored Bloom filter of all earlier keys lets through are counted
exactly, in the log's buckets that hold them; all other keys are new and unique.

``NewRowRelationships`` follows the log of the children and that of the parents.
The parents' integer keys are stored as bitmaps (exact, a bit per key), the orphans
as values with their number of rows; a batch of children is probed, and orphans
whose parent has come since are taken off.  No earlier child is read again.

After every batch the failures are those of the full check.  State lies in fresh
folders named by a manifest that appears whole or not at all; a batch that is
followed already changes nothing.  Batches are followed in the order of their ids,
and are not landed again afterwards.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finmart.operators.distinct_bitmaps import BITS, BLOCK, bit_is_set, distinct_bitmaps, united
from finmart.operators.key_filter import blocks_for, key_filter, let_through, merged_filters
from finmart.session import ensure_checkpoint_dir
from finmart.sources.storage import child_names, publish_text, read_text
from finmart.streaming.landing import LandingLog


class _Followed:
    def __init__(self, spark: SparkSession, root: str):
        ensure_checkpoint_dir(spark)
        self.spark, self.root = spark, root.rstrip("/")

    def state(self) -> dict:
        names = [n for n in child_names(self.spark, f"{self.root}/log") if n[0] != "."]
        return (json.loads(read_text(self.spark, f"{self.root}/log/{max(names)}")) if names
                else {"number": 0, "batches": [], "folder": None, "read_history": 0})

    def _stored(self, state: dict, part: str) -> DataFrame | None:
        return self.spark.read.parquet(f"{self.root}/{state['folder']}/{part}") if state["folder"] else None

    def _publish(self, state: dict, **parts: DataFrame) -> None:
        folder = f"data/{uuid.uuid4().hex[:12]}"
        for name, rows in parts.items():
            rows.write.parquet(f"{self.root}/{folder}/{name}")
        state = {**state, "number": state["number"] + 1, "folder": folder}
        publish_text(self.spark, f"{self.root}/log", f"{state['number']:012d}.json", json.dumps(state))


def _all(columns: list[str], test) -> Column:
    return reduce(lambda a, b: a & b, [test(F.col(c)) for c in columns])


class NewRowUnique(_Followed):
    """``key``: one column (NULLs don't count, as in ``unique``) or a combination
    (NULLs are values), the log's key among them."""

    def __init__(self, spark: SparkSession, root: str, log: LandingLog, key: list[str],
                 expected_keys: int = 10_000_000):
        super().__init__(spark, root)
        if log.key not in key:
            raise ValueError(f"the checked key must hold {log.key}, by which the log is bucketed")
        self.log, self.key, self._expected = log, key, expected_keys

    def _counted(self, rows: DataFrame) -> DataFrame:
        rows = rows.select(*self.key)
        rows = rows if len(self.key) > 1 else rows.filter(F.col(self.key[0]).isNotNull())
        return rows.groupBy(*self.key).agg(F.count(F.lit(1)).alias("n_records"))

    def follow(self, batch_id: int) -> None:
        state = self.state()
        if batch_id in state["batches"]:
            return
        blocks = state.setdefault("blocks", blocks_for(self._expected))
        new = self._counted(self.log.read(batch=batch_id)).checkpoint()
        stored, failures = self._stored(state, "filter"), self._stored(state, "failures")
        added, bad = key_filter(new, self.key, blocks), new.filter("n_records > 1")
        if stored is not None:
            seen = let_through(new, self.key, stored, blocks).select(*self.key).checkpoint()
            buckets = self.log.buckets_of(seen)  # the part of the log that can hold them
            earlier = self.log.read(buckets=buckets).filter(F.col("landed_batch").isin(state["batches"]))
            same = lambda a, b: reduce(
                lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in self.key])
            held = earlier.select(*self.key)
            before = self._counted(held.join(seen, same(held, seen), "left_semi"))
            state["read_history"] = len(buckets)
            both = new.unionByName(before).groupBy(*self.key).agg(F.sum("n_records").alias("n_records"))
            bad = both.filter("n_records > 1")
            bad = failures.join(bad, same(failures, bad), "left_anti").unionByName(bad)
            added = merged_filters(stored, added)
        state["batches"] = state["batches"] + [batch_id]
        self._publish(state, filter=added, failures=bad)

    def failures(self) -> DataFrame:
        """The keys that occur more than once in all batches followed, with their count."""
        return self._stored(self.state(), "failures")


class NewRowRelationships(_Followed):
    """Children's ``column`` (integer) must be a ``field`` of the parents."""

    def __init__(self, spark: SparkSession, root: str, children: LandingLog, column: str,
                 parents: LandingLog, field: str):
        super().__init__(spark, root)
        self.children, self.column, self.parents, self.field = children, column, parents, field

    def follow(self, batch_id: int) -> None:
        """Takes in the children and the parents of a batch (either may lack it)."""
        state = self.state()
        if batch_id in state["batches"]:
            return
        empty = f"value bigint, n bigint, {BLOCK} bigint, {BITS} binary"
        known, orphans = self._stored(state, "parents"), self._stored(state, "orphans")
        parts = [p for p in (known, self._ids(self.parents, batch_id, self.field)) if p is not None]
        parents = (united(reduce(DataFrame.unionByName, parts), []) if parts
                   else self.spark.createDataFrame([], empty).select(BLOCK, BITS)).checkpoint()
        counted = [orphans] if orphans is not None else []
        if batch_id in self.children.batches():
            value = F.col(self.column).cast("bigint").alias("value")
            counted.append(self.children.read(batch=batch_id).select(value).filter("value IS NOT NULL")
                           .groupBy("value").agg(F.count(F.lit(1)).alias("n")))
        rows = (reduce(DataFrame.unionByName, counted).groupBy("value").agg(F.sum("n").alias("n")) if counted
                else self.spark.createDataFrame([], empty).select("value", "n"))
        state["batches"] = state["batches"] + [batch_id]
        self._publish(state, parents=parents, orphans=self._without_parent(rows, parents))

    @staticmethod
    def _ids(log: LandingLog, batch_id: int, column: str) -> DataFrame | None:
        return distinct_bitmaps(log.read(batch=batch_id), [], column) if batch_id in log.batches() else None

    @staticmethod
    def _without_parent(rows: DataFrame, parents: DataFrame) -> DataFrame:
        found = bit_is_set(F.col(BITS), F.bitmap_bit_position("value"))
        probed = rows.withColumn(BLOCK, F.bitmap_bucket_number("value")).join(parents, BLOCK, "left")
        return probed.filter(~F.coalesce(found, F.lit(False))).select("value", "n")

    def failures(self) -> DataFrame:
        """Values without a parent and their number of rows (the failing rows)."""
        return self._stored(self.state(), "orphans")
