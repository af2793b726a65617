"""Global ranking without a single-partition window.

``Window.orderBy(...)`` with no partition pulls every row into one task.
Here the total order is produced by a range-partitioned distributed sort;
each row gets its index inside its sorted partition, the per-partition row
counts (one row per partition — a size bound independent of the data) give
each partition's offset, and position = offset + index.  The tagged sort is
checkpointed to the reliable checkpoint folder so the ids are fixed once
(a re-run of a lost task cannot renumber rows) and the lineage is cut.

ntile and rank are closed-form functions of the position:
  ntile(k): the first n % k buckets hold ceil(n/k) rows, the rest floor(n/k)
  rank:     the smallest position among rows with the same order values
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finmart.session import ensure_checkpoint_dir


def with_global_position(df: DataFrame, order: list[Column], pos_col: str = "_pos",
                         total_col: str | None = None) -> DataFrame:
    """Add the 1-based position of each row in the total order ``order``.

    ``order`` must be a total order (append a unique key as tie-break) for the
    result to be deterministic.
    """
    ensure_checkpoint_dir(df.sparkSession)
    tagged = (df.orderBy(*order)
                .withColumn("_rk_part", F.spark_partition_id())
                .withColumn("_rk_id", F.monotonically_increasing_id())
                .checkpoint(eager=True))
    counts = tagged.groupBy("_rk_part").agg(F.count(F.lit(1)).alias("_rk_n"),
                                            F.min("_rk_id").alias("_rk_first"))
    # One row per partition: the offset window is bounded by the partition count.
    w = Window.orderBy("_rk_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_rk_part", "_rk_first",
        F.coalesce(F.sum("_rk_n").over(w), F.lit(0)).alias("_rk_offset"),
        F.sum("_rk_n").over(Window.partitionBy()).alias("_rk_total"))
    out = (tagged.join(F.broadcast(offsets), "_rk_part")
                 .withColumn(pos_col, F.col("_rk_offset") + F.col("_rk_id") - F.col("_rk_first") + 1))
    if total_col:
        out = out.withColumnRenamed("_rk_total", total_col)
    return out.drop("_rk_part", "_rk_id", "_rk_first", "_rk_offset", "_rk_total")


def ntile_of(pos: Column, total: Column, k: int) -> Column:
    """Bucket (1..k) of 1-based position ``pos`` among ``total`` rows."""
    q = F.floor(total / k).cast("long")
    r = (total % k).cast("long")
    big = r * (q + 1)
    return (F.when(pos <= big, F.floor((pos - 1) / (q + 1)) + 1)
             .otherwise(r + F.floor((pos - 1 - big) / F.greatest(q, F.lit(1))) + 1)).cast("int")


def global_ntile(df: DataFrame, k: int, order: list[Column], out_col: str) -> DataFrame:
    """``ntile(k) over (order by …)`` computed distributed."""
    pos = with_global_position(df, order, "_nt_pos", total_col="_nt_total")
    return (pos.withColumn(out_col, ntile_of(F.col("_nt_pos"), F.col("_nt_total"), k))
               .drop("_nt_pos", "_nt_total"))


def global_rank(df: DataFrame, value_cols: list[str], order: list[Column], out_col: str,
                tie_break: list[Column] | None = None) -> DataFrame:
    """``rank() over (order by value_cols …)`` computed distributed.

    ``order`` orders by ``value_cols``; ``tie_break`` makes it total.  Rows with
    equal values share the first position of their group (groupBy with
    map-side combine, so a hot value does not land whole in one task).
    """
    pos = with_global_position(df, order + (tie_break or []), "_rnk_pos")
    firsts = pos.groupBy(*value_cols).agg(F.min("_rnk_pos").alias(out_col))
    firsts = firsts.select(*[F.col(c).alias(f"_rnk_{c}") for c in value_cols], out_col)
    cond = None
    for c in value_cols:
        e = pos[c].eqNullSafe(firsts[f"_rnk_{c}"])
        cond = e if cond is None else cond & e
    return (pos.join(firsts, cond, "inner")
               .drop("_rnk_pos", *[f"_rnk_{c}" for c in value_cols])
               .withColumn(out_col, F.col(out_col).cast("long")))
