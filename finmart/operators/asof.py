"""As-of (interval) left join.

Left rows pick the right version whose half-open validity window
[valid_from, valid_to) contains the left timestamp, on an equality key.
Expressed as one equi-join with a range residual so Catalyst can choose a
broadcast hash join (small dimension) or a sort-merge join, and AQE can split
a skewed key on the left side — no per-key Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def asof_left_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                   left_time: Column, valid_from: str = "valid_from",
                   valid_to: str = "valid_to", right_cols: dict[str, str] | None = None) -> DataFrame:
    """``left`` ⟕ ``right`` on key equality and valid_from <= t < valid_to.

    ``right_cols`` maps right column → output name (defaults to all right
    columns except the join columns).
    """
    if right_cols is None:
        right_cols = {c: c for c in right.columns if c not in (right_key, valid_from, valid_to)}
    r = right.select(F.col(right_key).alias("_asof_k"), F.col(valid_from).alias("_asof_from"),
                     F.col(valid_to).alias("_asof_to"),
                     *[F.col(c).alias(n) for c, n in right_cols.items()])
    l = left.withColumn("_asof_t", left_time)
    cond = ((l[left_key] == r["_asof_k"]) & (l["_asof_t"] >= r["_asof_from"])
            & (l["_asof_t"] < r["_asof_to"]))
    return (l.join(r, cond, "left")
             .drop("_asof_k", "_asof_from", "_asof_to", "_asof_t"))
