"""Comparing all rows that share a block key, whatever the block's size.

A block is dealt into chunks by a hash of its rows, and every pair of chunks is
a group of its own with at most two chunks of rows.  So no task ever holds a
block as a whole, and a block that holds a third of all rows is spread over
all tasks.  Blocks of one row (nearly all) are gone before that.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finmart.llm.common import checkpointed

#: Rows of a chunk; a group to compare holds two chunks, so about twice as many.
CHUNK_ROWS = 512


def paired_chunks(rows: DataFrame, key: str, row_id: str, chunk: int = CHUNK_ROWS) -> DataFrame:
    """``rows`` dealt to groups: adds ``_g`` (group id within the key) and
    ``_side`` (0 or 1).  Rows of a key meet in exactly one group per pair:
    inside a chunk in its own group (all ``_side`` 0), across chunks as side 0
    against side 1.  ``row_id`` must tell apart the rows of a key."""
    # The counts go to the shared folder: the join then has an exchange of its
    # own on both sides, and Spark can split the partition of a hot key.
    counts = checkpointed(rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
                          .filter("_n > 1"))
    chunks = F.ceil(F.col("_n") / chunk).cast("int")
    dealt = rows.join(counts, key).withColumn("_k", chunks).withColumn(
        "_c", F.pmod(F.xxhash64(F.lit(key), F.col(row_id)), F.col("_k")).cast("int"))
    dealt = dealt.withColumn("_o", F.explode(F.expr("sequence(0, _k - 1)")))
    return dealt.select(
        *rows.columns,
        F.xxhash64(key, F.least("_c", "_o"), F.greatest("_c", "_o")).alias("_g"),
        (F.col("_c") > F.col("_o")).cast("int").alias("_side"))


def compare_groups(groups: DataFrame, key: str, order: str, compare: Callable, schema: str) -> DataFrame:
    """``compare(batch, groups)`` over whole groups of ``paired_chunks``: it gets
    an Arrow batch sorted by group and the bounds of the groups in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            k, g = (table.column(c).to_numpy() for c in (key, "_g"))
            starts = np.flatnonzero((k[1:] != k[:-1]) | (g[1:] != g[:-1])) + 1
            if not len(starts):
                held = [table]
                continue
            last = int(starts[-1])  # the last group may go on in the next batch
            yield from compare(table.slice(0, last), np.concatenate([[0], starts]))
            held = [table.slice(last)]
        if held:
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            yield from compare(table, np.array([0, table.num_rows]))

    return (groups.repartition(key, "_g").sortWithinPartitions(key, "_g", "_side", order)
            .mapInArrow(run, schema))


def linked_stars(links: np.ndarray) -> list[tuple[int, int]]:
    """Edges (root, member) that connect what the symmetric matrix connects: a
    row less than the members, where the pairs could be all of them."""
    left = links.any(axis=0)
    out = []
    while left.any():
        root = int(np.argmax(left))
        left[root] = False
        front = np.array([root])
        while len(front):
            reached = links[front].any(axis=0) & left
            left &= ~reached
            front = np.flatnonzero(reached)
            out += [(root, int(i)) for i in front]
    return out
