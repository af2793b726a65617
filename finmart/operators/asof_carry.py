"""As-of left join for keys with many versions: sort and carry forward.

The join on key equality with a range residual looks at every pair of a key's
rows and versions.  Here rows and versions are put in one order of time per key,
and each row takes the last version before it: the work is linear in rows plus
versions.  A key's time is cut into slices, so one that holds a third of all rows is
many partitions; a slice begins with the version that was open at its start, which
follows from one row per key and slice (the last version that begins in it).

Same rows as ``asof_left_join`` for versions of a key that don't overlap (a type-2
history); versions without a span are never valid.  Rows without key or time, and
rows in a gap, have no version.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Length of a slice of a key's time.
SLICE_DAYS = 92


def asof_carry_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_time: Column,
                    valid_from: str = "valid_from", valid_to: str = "valid_to",
                    right_cols: dict[str, str] | None = None, slice_days: int = SLICE_DAYS) -> DataFrame:
    if right_cols is None:
        right_cols = {c: c for c in right.columns if c not in (right_key, valid_from, valid_to)}
    kind = left.schema[left_key].dataType

    def sliced(t: Column) -> Column:
        return F.floor(F.unix_date(t.cast("date")) / slice_days).cast("bigint")

    rows = left.select(F.struct("*").alias("l"), F.col(left_key).alias("k"),
                       left_time.cast("timestamp_ntz").alias("t"))
    known = F.col("k").isNotNull() & F.col("t").isNotNull()
    versions = right.select(
        F.col(right_key).cast(kind).alias("k"), F.col(valid_from).cast("timestamp_ntz").alias("t"),
        F.struct(F.col(valid_from).cast("timestamp_ntz").alias("from"),
                 F.col(valid_to).cast("timestamp_ntz").alias("to"),
                 *[F.col(c).alias(n) for c, n in right_cols.items()]).alias("v"))
    versions = versions.filter(F.col("k").isNotNull() & (F.col("v.from") < F.col("v.to"))).withColumn(
        "s", sliced(F.col("t")))
    timed = rows.filter(known).withColumn("s", sliced(F.col("t")))

    # slices of a key in which something happens, with the last version that begins in each
    last = versions.groupBy("k", "s").agg(F.max("v").alias("v"))
    none = F.lit(None).cast(versions.schema["v"].dataType)
    slices = last.unionByName(timed.select("k", "s").distinct().withColumn("v", none)).groupBy("k", "s").agg(
        F.max("v").alias("v"))
    before = Window.partitionBy("k").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    begun = slices.select("k", "s", F.last("v", ignorenulls=True).over(before).alias("v")).filter("v IS NOT NULL")

    no_row = F.lit(None).cast(rows.schema["l"].dataType)
    # a slice's first version sorts before all that happens in it, a version before rows of its time
    events = (begun.select("k", "s", F.lit(0).alias("o"), F.lit(None).cast("timestamp_ntz").alias("t"), "v",
                           no_row.alias("l"))
              .unionByName(versions.select("k", "s", F.lit(1).alias("o"), "t", "v", no_row.alias("l")))
              .unionByName(timed.select("k", "s", F.lit(2).alias("o"), "t", none.alias("v"), "l")))
    in_time = Window.partitionBy("k", "s").orderBy(F.col("t").asc_nulls_first(), "o").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    carried = events.withColumn("v", F.last("v", ignorenulls=True).over(in_time)).filter("o = 2")
    valid = F.col("t") < F.col("v.to")
    found = carried.select("l", F.when(valid, F.col("v")).alias("v"))
    out = found.unionByName(rows.filter(~known).select("l", none.alias("v")))
    return out.select("l.*", *[F.col(f"v.{n}").alias(n) for n in right_cols.values()])
