"""A three-extract customer history derived from the delivered customer table.

The delivered data has a single customer extract, so SCD2 behaviour
(changes, hard deletes, re-appearance, gaps) is exercised with a scenario
computed from the whole table:

  run 1 (1995-01-01): the extract as delivered
  run 2 (1998-01-01): keys divisible by 7 move to the next market segment,
                      keys divisible by 11 are removed
  run 3 (2000-01-01): as run 2, but keys divisible by 22 are back
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The market segments in order; "next" wraps around.
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
# Snapshot times of the three runs.
HISTORY_RUNS = ["1995-01-01 00:00:00", "1998-01-01 00:00:00", "2000-01-01 00:00:00"]
MOVE_EVERY, REMOVE_EVERY, RETURN_EVERY = 7, 11, 22


def _next_segment(c):
    expr = None
    for cur, nxt in zip(SEGMENTS, SEGMENTS[1:] + SEGMENTS[:1]):
        expr = (F.when(c == cur, F.lit(nxt)) if expr is None
                else expr.when(c == cur, F.lit(nxt)))
    return expr.otherwise(c)


def customer_extracts(customer: DataFrame) -> list[tuple[str, DataFrame]]:
    """[(as_of, extract)] for the three runs; every extract is the whole table
    minus the removed keys."""
    key = F.col("c_custkey")
    moved = customer.withColumn(
        "c_mktsegment",
        F.when(key % MOVE_EVERY == 0, _next_segment(F.col("c_mktsegment")))
         .otherwise(F.col("c_mktsegment")))
    run2 = moved.filter(key % REMOVE_EVERY != 0)
    run3 = moved.filter((key % REMOVE_EVERY != 0) | (key % RETURN_EVERY == 0))
    return list(zip(HISTORY_RUNS, [customer, run2, run3]))
