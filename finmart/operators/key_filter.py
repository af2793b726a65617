"""A stored Bloom filter of keys, in blocks.

A key's hash chooses a block of 32,768 bits and ``PROBES`` bits in it.  The filter
is a table with a row per block that has keys; it is built by an aggregation, a
union of two filters is the OR of their blocks, and a probe is a join on the block.
A key that was put in is always let through; one that was not is let through
rarely, as long as there are enough blocks (``blocks_for``).
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finmart.operators.distinct_bitmaps import bit_is_set

BLOCK_BITS, PROBES = 32_768, 6
#: Bits per key for about one false positive in a hundred and fifty.
BITS_PER_KEY = 12


def blocks_for(keys: int) -> int:
    return max(1, math.ceil(keys * BITS_PER_KEY / BLOCK_BITS))


def _block(key: list[str], blocks: int) -> Column:
    return F.pmod(F.xxhash64(*key, F.lit(1)), F.lit(blocks)).cast("bigint")


def _bits(key: list[str]) -> list[Column]:
    start, step = F.xxhash64(*key, F.lit(2)), F.xxhash64(*key, F.lit(3)).bitwiseOR(F.lit(1))
    return [F.pmod(F.pmod(start, F.lit(BLOCK_BITS)) + F.lit(i) * F.pmod(step, F.lit(BLOCK_BITS)),
                   F.lit(BLOCK_BITS)).cast("bigint") for i in range(PROBES)]


def key_filter(rows: DataFrame, key: list[str], blocks: int) -> DataFrame:
    """block, bits: the filter of the keys of ``rows``."""
    bits = rows.select(_block(key, blocks).alias("block"), F.explode(F.array(*_bits(key))).alias("bit"))
    return bits.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits"))


def merged_filters(*filters: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, filters).groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))


def let_through(rows: DataFrame, key: list[str], stored: DataFrame, blocks: int) -> DataFrame:
    """The rows whose key may be in the filter (all that are in it, few others)."""
    probed = rows.withColumn("_block", _block(key, blocks)).join(
        stored.select(F.col("block").alias("_block"), "bits"), "_block")
    every = reduce(lambda a, b: a & b, [bit_is_set(F.col("bits"), b) for b in _bits(key)])
    return probed.filter(every).select(*rows.columns)
