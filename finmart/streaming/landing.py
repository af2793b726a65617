"""A landing log: batches of rows in hash buckets of their key.

Layout under ``root``:

  data/<batch>-<run>/bucket=<b>/   rows a landing has written, never changed
  log/<n>.json                     which folders make up state n of the log

A landing writes a fresh folder and then publishes the next state, which
appears whole or not at all: a batch that runs again replaces its former folder,
a run that died leaves one that nothing names (``vacuum`` removes those).  A state
lists, per folder, its batches, its buckets and the schema it was written with,
so a reader opens the folders of the buckets it asks for and no others.

``compact`` rewrites the folders of many small batches as one, a file or a few
per bucket, and may leave out rows that later batches replace; its batches can't
be landed again.  Every row carries its batch (``landed_batch``) and whether that
batch replaces earlier rows of its keys (``landed_replaces``).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finmart.sources.sinks import CODEC
from finmart.sources.storage import child_names, delete_folder, publish_text, read_text
from finmart.streaming.schema_change import Change, reconcile, union_conformed

BATCH, REPLACES, BUCKET = "landed_batch", "landed_replaces", "bucket"
_ROW_FIELDS = [T.StructField(BATCH, T.LongType()), T.StructField(REPLACES, T.BooleanType())]


class LandingLog:
    """Batches of one entity, bucketed by ``key``.  ``buckets`` and nothing else
    is fixed when the log begins; ``policy`` is what a change of schema means
    (see ``schema_change``)."""

    def __init__(self, spark: SparkSession, root: str, key: str, buckets: int = 256,
                 policy: str = "append", required: tuple[str, ...] = ()):
        self.spark, self.root, self.key = spark, root.rstrip("/"), key
        self.policy, self.required = policy, (key, *required)
        self._buckets = buckets

    # ---- states

    def state(self) -> dict:
        names = [n for n in child_names(self.spark, f"{self.root}/log") if n[0] != "."]
        if not names:
            return {"number": 0, "buckets": self._buckets, "schema": None, "folders": [], "changes": []}
        return json.loads(read_text(self.spark, f"{self.root}/log/{max(names)}"))

    def _publish(self, state: dict) -> None:
        state = {**state, "number": state["number"] + 1}
        publish_text(self.spark, f"{self.root}/log", f"{state['number']:012d}.json", json.dumps(state))

    def schema(self) -> T.StructType | None:
        """Columns of the rows as landed (None before the first batch)."""
        known = self.state()["schema"]
        return T.StructType.fromJson(known) if known else None

    def token(self, batch_id: int) -> str:
        """The folder a batch is in; a batch that is landed again has a new one."""
        return next((f["folder"].split("/")[-1] for f in self.state()["folders"]
                     if batch_id in f["batches"]), "")

    def batches(self) -> list[int]:
        return sorted(b for f in self.state()["folders"] for b in f["batches"])

    def changes(self) -> DataFrame:
        """What differed in the schema of each batch."""
        rows = [(c["batch"], c["column"], c["change"], c["table_type"], c["batch_type"])
                for c in self.state()["changes"]]
        return self.spark.createDataFrame(rows, "batch bigint, column string, change string, "
                                                "table_type string, batch_type string")

    # ---- writing

    def bucket_of(self, key: str | Column, buckets: int | None = None) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(buckets or self.state()["buckets"])).cast("int")

    def _write(self, rows: DataFrame, name: str, buckets: int, parts: int = 1) -> tuple[str, list[int]]:
        """Rows in a fresh folder by bucket, sorted by key inside the files (so a
        file's statistics narrow a search).  The hint lets Spark size the tasks: a
        hot bucket is split, small ones share a task.  ``parts`` are written one after
        the other, so shuffle files hold one of them at a time; each reads ``rows``."""
        folder = f"data/{name}-{uuid.uuid4().hex[:12]}"
        rows = rows.withColumn(BUCKET, self.bucket_of(self.key, buckets))
        for i in range(parts):
            part = rows.filter(F.col(BUCKET) % parts == i) if parts > 1 else rows
            (part.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, self.key).write
                 .mode("append").option("compression", CODEC).partitionBy(BUCKET)
                 .parquet(f"{self.root}/{folder}"))
        found = child_names(self.spark, f"{self.root}/{folder}")
        return folder, sorted(int(n.split("=")[1]) for n in found if n.startswith(f"{BUCKET}="))

    def land(self, batch_id: int, df: DataFrame, replace: bool = False, parts: int = 1) -> list[Change]:
        """Adds a batch (or replaces the batch of this id); what differed in its
        schema.  ``replace``: its rows stand for all earlier rows of their keys.
        ``parts`` above 1: ``df`` is run so many times, and must give the same rows each time."""
        state = self.state()
        if any(batch_id in f["batches"] and len(f["batches"]) > 1 for f in state["folders"]):
            raise ValueError(f"batch {batch_id} is compacted, it can't be landed again")
        others = [f for f in state["folders"] if f["batches"] != [batch_id]]
        known = T.StructType.fromJson(state["schema"]) if state["schema"] and others else None
        schema, changes = reconcile(known, df.schema, self.policy, self.required)
        rows = df.withColumn(BATCH, F.lit(batch_id).cast("bigint")).withColumn(REPLACES, F.lit(replace))
        folder, buckets = self._write(rows, f"{batch_id:012d}", state["buckets"], parts)
        entry = {"folder": folder, "batches": [batch_id], "buckets": buckets,
                 "schema": df.schema.jsonValue()}
        log = [c for c in state["changes"] if c["batch"] != batch_id]
        self._publish({**state, "schema": schema.jsonValue(), "folders": others + [entry],
                       "changes": log + [{"batch": batch_id, **c.as_dict()} for c in changes]})
        return changes

    def compact(self, through: int, keep: Callable[[DataFrame], DataFrame] | None = None) -> int:
        """One folder instead of those of the batches up to ``through``; the
        number of folders that went.  ``keep`` may leave rows out."""
        state = self.state()
        old = [f for f in state["folders"] if max(f["batches"]) <= through]
        if len(old) < 2:
            return 0
        rows = self._rows(old, T.StructType.fromJson(state["schema"]), None)
        rows = keep(rows) if keep else rows
        folder, buckets = self._write(rows, f"compact-{through:012d}", state["buckets"])
        entry = {"folder": folder, "batches": sorted(b for f in old for b in f["batches"]),
                 "buckets": buckets, "schema": rows.drop(BATCH, REPLACES).schema.jsonValue()}
        self._publish({**state, "folders": [entry] + [f for f in state["folders"] if f not in old]})
        return len(old)

    def vacuum(self) -> list[str]:
        """Removes folders and states that the newest state does not need."""
        state = self.state()
        named = {f["folder"] for f in state["folders"]}
        gone = [f"data/{n}" for n in child_names(self.spark, f"{self.root}/data") if f"data/{n}" not in named]
        gone += [f"log/{n}" for n in child_names(self.spark, f"{self.root}/log")
                 if n.endswith(".json") and n != f"{state['number']:012d}.json"]
        for path in gone:
            delete_folder(self.spark, f"{self.root}/{path}")
        return gone

    # ---- reading

    def buckets_of(self, ids: DataFrame) -> list[int]:
        """The buckets that hold these keys (at most the number of buckets)."""
        return sorted(r[0] for r in ids.select(self.bucket_of(self.key)).distinct().collect())

    def _rows(self, folders: list[dict], schema: T.StructType, buckets: list[int] | None) -> DataFrame:
        wanted = None if buckets is None else set(buckets)
        by_schema: dict[str, list[str]] = {}
        for f in folders:
            paths = [f"{self.root}/{f['folder']}/{BUCKET}={b}" for b in f["buckets"]
                     if wanted is None or b in wanted]
            by_schema.setdefault(json.dumps(f["schema"]), []).extend(paths)
        parts = []
        for text, paths in by_schema.items():  # files of one schema are read together
            if paths:
                written = T.StructType(T.StructType.fromJson(json.loads(text)).fields + _ROW_FIELDS)
                parts.append(self.spark.read.schema(written).parquet(*paths))
        full = T.StructType(schema.fields + _ROW_FIELDS)
        return union_conformed(parts, full) if parts else self.spark.createDataFrame([], full)

    def read(self, buckets: list[int] | None = None, batch: int | None = None) -> DataFrame | None:
        """Landed rows (of some buckets, of one batch) with ``landed_batch`` and
        ``landed_replaces``; None before the first batch."""
        state = self.state()
        if not state["folders"]:
            return None
        folders = [f for f in state["folders"] if batch is None or batch in f["batches"]]
        rows = self._rows(folders, T.StructType.fromJson(state["schema"]), buckets)
        return rows if batch is None else rows.filter(F.col(BATCH) == batch)
