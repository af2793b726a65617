"""Exact distinct counts that can be merged.

``count(distinct ...)`` of a month can't be added to that of another month.  The
distinct ids themselves can be united: per group and block of 32,768 ids a bitmap
with a bit per id.  Bitmaps of days, months or batches are stored; the distinct
count of any union of them is the number of bits of their OR.  Building one is an
aggregation with map-side combine; a group's blocks are rows of their own.

A bitmap takes 4 KB however few ids it holds.  Where groups are many and hold few
ids each (the orders of a customer's month), ``sparse`` makes a block 64 ids and its
bits one integer: a group costs a small row per id at most.  Both forms are united
and counted by the same functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK, BITS = "id_block", "id_bits"
#: Ids of a block of the sparse form.
WORD = 64


def _is_sparse(bitmaps: DataFrame) -> bool:
    return dict(bitmaps.dtypes)[BITS] == "bigint"


def distinct_bitmaps(rows: DataFrame, keys: list[str], ids: Column | str, sparse: bool = False) -> DataFrame:
    """keys, ``id_block``, ``id_bits``: the distinct integer ids of each group
    (NULL ids are none)."""
    ids = (F.col(ids) if isinstance(ids, str) else ids).cast("bigint")
    known = rows.select(*keys, ids.alias("_id")).filter("_id IS NOT NULL")
    if sparse:
        place = F.expr(f"shiftleft(1L, cast(pmod(_id, {WORD}) AS int))")
        return known.groupBy(*keys, F.shiftright("_id", WORD.bit_length() - 1).alias(BLOCK)).agg(
            F.bit_or(place).alias(BITS))
    return known.groupBy(*keys, F.bitmap_bucket_number("_id").alias(BLOCK)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_id")).alias(BITS))


def bit_is_set(bits: Column, position: Column) -> Column:
    """Whether a bitmap holds the bit at this place."""
    byte = F.conv(F.hex(F.substring(bits, (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10)
    return F.getbit(byte.cast("int"), (position % 8).cast("int")) == 1


def united(bitmaps: DataFrame, keys: list[str]) -> DataFrame:
    """Bitmaps of coarser groups (any ``keys`` of the given ones, or new columns)."""
    either = F.bit_or if _is_sparse(bitmaps) else F.bitmap_or_agg
    return bitmaps.groupBy(*keys, BLOCK).agg(either(BITS).alias(BITS))


def distinct_counts(bitmaps: DataFrame, keys: list[str], name: str = "n_distinct") -> DataFrame:
    """The number of distinct ids per group of ``keys``."""
    counts = united(bitmaps, keys).groupBy(*keys) if keys else united(bitmaps, keys)
    n_bits = F.bit_count if _is_sparse(bitmaps) else F.bitmap_count
    return counts.agg(F.coalesce(F.sum(n_bits(BITS)), F.lit(0)).cast("bigint").alias(name))


def rolling_months(bitmaps: DataFrame, keys: list[str], months: int, month: str = "order_year_month_key",
                   name: str = "n_distinct") -> DataFrame:
    """Distinct ids per group in every window of ``months`` calendar months that
    ends in a month of the data's span, by the window's last month."""
    index = F.col(month).cast("int")
    index = F.floor(index / 100) * 12 + index % 100 - 1
    rows = bitmaps.withColumn("_m", index.cast("int"))
    last = rows.select(F.max("_m")).scalar()
    ends = rows.withColumn("_end", F.explode(F.sequence(F.col("_m"), F.col("_m") + (months - 1)))).filter(
        F.col("_end") <= last)
    key = (F.floor(F.col("_end") / 12) * 100 + F.col("_end") % 12 + 1).cast("int")
    return distinct_counts(ends.withColumn(month, key), [*keys, month], name)
