"""A table kept from a change log: inserts, updates and deletes with a sequence
number, in batches of any cut and order.

A change has ``op`` (I, U or D), ``seq`` (of one order across the log), the key,
and the columns; ``changed`` names the columns that an update sets (NULL: all of
them; an insert always sets all).  Per key the state holds the newest delete, the
newest insert or update, and for every column the newest change that set it:

    value of a column = the one with the greatest seq, if that is beyond the newest delete

Every part is a maximum, so it does not matter how the log is cut into batches,
in which order they come, or whether changes come twice: the table is the same.
An update that comes before its insert shows the columns it sets; the insert fills
in the rest.  Where two changes of a key have the same seq, a delete wins, else
the greater value.  A deleted key stays in the state (a late change must not bring
it back) until ``forget`` removes deletes older than any change still to come.

The state lies in hash buckets of the key, in immutable folders that a manifest
names; a batch reads and writes the buckets of its keys only.  Changes without
key, seq or a known op are rejected and stored with the reason.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from finmart.session import ensure_checkpoint_dir
from finmart.sources.storage import child_names, delete_folder, publish_text, read_text

OPS = ("I", "U", "D")
_BUCKET, _DELETED, _LIVE = "bucket", "_deleted_seq", "_live_seq"


def _reason(key: list[str]) -> Column:
    no_key = F.lit(False)
    for k in key:
        no_key = no_key | F.col(k).isNull()
    return (F.when(no_key, "key_null").when(F.col("seq").isNull(), "seq_null")
            .when(F.col("op").isNull() | ~F.col("op").isin(*OPS), "op_unknown"))


def _merged(rows: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """The newest of everything per key (combined on the map side)."""
    return rows.groupBy(*key).agg(*[F.max(c).alias(c) for c in (_DELETED, _LIVE, *columns)])


def as_state(changes: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """One row per change in the form of the state."""
    sets = F.col("op") != "D"
    seq = F.col("seq").cast("bigint")

    def of(c: str) -> Column:
        here = sets & ((F.col("op") == "I") | F.col("changed").isNull() | F.array_contains("changed", c))
        return F.when(here, F.struct(seq.alias("seq"), F.col(c).alias("value"))).alias(c)

    return changes.select(*key, F.when(~sets, seq).alias(_DELETED), F.when(sets, seq).alias(_LIVE),
                          *[of(c) for c in columns])


def visible(state: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """The rows that the state stands for."""
    gone = F.coalesce(F.col(_DELETED), F.lit(-(2 ** 63)))
    return state.filter(F.col(_LIVE) > gone).select(
        *key, *[F.when(F.col(c)["seq"] > gone, F.col(c)["value"]).alias(c) for c in columns])


class ChangeTable:
    def __init__(self, spark: SparkSession, root: str, key: list[str], buckets: int = 64):
        ensure_checkpoint_dir(spark)
        self.spark, self.root, self.key, self._buckets = spark, root.rstrip("/"), key, buckets

    def state(self) -> dict:
        names = [n for n in child_names(self.spark, f"{self.root}/log") if n[0] != "."]
        if names:
            return json.loads(read_text(self.spark, f"{self.root}/log/{max(names)}"))
        return {"number": 0, "buckets": self._buckets, "schema": None, "folders": {}, "rejected": []}

    def _columns(self, schema: StructType) -> list[str]:
        return [c for c in schema.names if c not in (*self.key, _DELETED, _LIVE)]

    def _read(self, state: dict, buckets: list[str] | None = None) -> DataFrame:
        schema = StructType.fromJson(state["schema"])
        paths = [f"{self.root}/{f}" for b, f in state["folders"].items() if buckets is None or b in buckets]
        return (self.spark.read.schema(schema).parquet(*paths) if paths
                else self.spark.createDataFrame([], schema))

    def _publish(self, state: dict, rows: DataFrame, buckets: list[str], **more) -> None:
        """``rows`` in place of the state of these buckets."""
        folder = f"data/{uuid.uuid4().hex[:12]}"
        (rows.withColumn(_BUCKET, self._bucket(state)).hint("rebalance", _BUCKET)
             .write.partitionBy(_BUCKET).parquet(f"{self.root}/{folder}"))
        written = {n.split("=")[1]: f"{folder}/{n}" for n in child_names(self.spark, f"{self.root}/{folder}")
                   if n.startswith(f"{_BUCKET}=")}
        same = {b: f for b, f in state["folders"].items() if b not in buckets}
        publish_text(self.spark, f"{self.root}/log", f"{state['number'] + 1:012d}.json", json.dumps({
            **state, **more, "number": state["number"] + 1, "folders": {**same, **written}}))

    def _bucket(self, state: dict) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(state["buckets"])).cast("int")

    def apply(self, changes: DataFrame) -> None:
        """Takes in a batch; taking it in again changes nothing (but its rejects
        are stored again)."""
        state = self.state()
        if "changed" not in changes.columns:
            changes = changes.withColumn("changed", F.lit(None).cast("array<string>"))
        judged = changes.withColumn("_reason", _reason(self.key))
        columns = [c for c in changes.columns if c not in (*self.key, "op", "seq", "changed")]
        batch = _merged(as_state(judged.filter("_reason IS NULL"), self.key, columns), self.key,
                        columns).checkpoint()
        if state["schema"] and self._columns(StructType.fromJson(state["schema"])) != columns:
            raise ValueError("the columns of a change log are those of its first batch")
        state["schema"] = state["schema"] or batch.schema.jsonValue()
        rejects = judged.filter("_reason IS NOT NULL").withColumnRenamed("_reason", "reason")
        path = f"rejected/{uuid.uuid4().hex[:12]}"
        rejects.write.parquet(f"{self.root}/{path}")
        # at most as many values as there are buckets
        buckets = [str(r[0]) for r in batch.select(self._bucket(state)).distinct().collect()]
        rows = _merged(self._read(state, buckets).unionByName(batch), self.key, columns)
        self._publish(state, rows, buckets, rejected=state["rejected"] + [path])

    def rows(self) -> DataFrame | None:
        """The table (None before the first batch)."""
        state = self.state()
        if not state["schema"]:
            return None
        return visible(self._read(state), self.key, self._columns(StructType.fromJson(state["schema"])))

    def rejected(self) -> DataFrame | None:
        paths = [f"{self.root}/{p}" for p in self.state()["rejected"]]
        return self.spark.read.parquet(*paths) if paths else None

    def forget(self, before_seq: int) -> None:
        """Removes the keys that were deleted before ``before_seq`` and not changed
        since: no change older than it may come any more."""
        state = self.state()
        if not state["schema"]:
            return
        alive = F.col(_DELETED).isNull() | (F.col(_LIVE) > F.col(_DELETED)) | (F.col(_DELETED) >= before_seq)
        self._publish(state, self._read(state).filter(alive), list(state["folders"]))

    def vacuum(self) -> None:
        named = {f.rsplit("/", 1)[0] for f in self.state()["folders"].values()}
        for n in child_names(self.spark, f"{self.root}/data"):
            if f"data/{n}" not in named:
                delete_folder(self.spark, f"{self.root}/data/{n}")
