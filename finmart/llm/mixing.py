"""Mixing sources to target weights with a curriculum that changes over time.

Every source has a weight that moves linearly from the beginning to the end of
training; its integral over training is the source's share of all tokens (here
words).  A target never exceeds ``MAX_REPEATS`` times what the source has; the
excess goes to the other sources by weight until none is above its cap.  The
documents of a source are taken in the order of a hash, whole epochs first and
then the part of an epoch that is left (``taken`` counts its words to the target's
last; ``copies`` counts documents, the last one if half of it is taken), so a document's place in its source is
a cumulative number of tokens.  The source's cumulative demand is the integral
of its weight schedule; inverting it at that place gives the training position
(0 to 1) of each copy.  Documents are then range-sorted by position.

Running totals are made in two steps: totals per source and hash bucket are
one small aggregation, and the documents of a bucket are summed by themselves.
So a source that holds a third of all rows is thousands of buckets, and no task
sees it as a whole.

Defined results: a null text has no words; rows without words are kept with
taken 0; the null source is a source of its own, the last one; equal rows get
neighbouring places in any order (the rows of the result are the same);
repeated rows count each; extra columns are ignored or, in ``training_order``,
kept; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finmart.llm.common import checkpointed

#: Weights of the sources in their order, repeating.
WEIGHTS = (1, 2, 3)
#: How the weight moves, per place in that cycle: its value at time t (0 to 1)
#: is weight * (1 + slope * (2t - 1)), whose integral is the weight.
SLOPES = (-0.5, 0.0, 0.5)
MAX_REPEATS = 3
#: Hex digits of the order hash that make a bucket (4096 buckets per source).
BUCKET_DIGITS = 3

_WORD = r"[^\x20\x09-\x0D]+"


def _keys(docs: DataFrame, doc_id: str, text: str, source: str) -> list[Column]:
    """Size, order hash, bucket and source key (null apart from the empty name)."""
    content = F.coalesce(F.col(text), F.lit(""))
    name = F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"), content)
    order = F.md5(name.cast("binary"))
    return [F.regexp_count(content, F.lit(_WORD)).cast("bigint").alias("_size"),
            order.alias("_order"), F.substring(order, 1, BUCKET_DIGITS).alias("_bucket"),
            F.col(source).isNull().alias("_no_source"),
            F.coalesce(F.col(source), F.lit("")).alias("_source")]


def source_targets(sources: DataFrame) -> DataFrame:
    """Adds place, weight, slope and target to one row per source (its key and
    ``source_size``).  With the sources in the order of cap by weight, those
    under their fair share form a prefix, so one pass finds the level at which
    the rest shares by weight.  One row per source: a catalogue, in one task."""
    place = F.row_number().over(Window.orderBy("_no_source", "_source")) - 1
    cycle = [F.array(*[F.lit(float(x)) for x in v]) for v in (WEIGHTS, SLOPES)]
    rows = sources.withColumn("_place", F.pmod(place, F.lit(len(WEIGHTS)))).select(
        "*", F.get(cycle[0], F.col("_place")).alias("weight"),
        F.get(cycle[1], F.col("_place")).alias("slope"),
        (F.lit(float(MAX_REPEATS)) * F.col("source_size")).alias("_cap"))
    by_ratio = Window.orderBy(F.col("_cap") / F.col("weight"), "_no_source", "_source")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(Window.partitionBy())
              - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
             / F.sum("weight").over(rest))
    rows = rows.withColumn("_level", level)
    fits = F.when(F.col("_level") * F.col("weight") <= F.col("_cap"), F.col("_level"))
    # the first level that its own source can take holds for all after it
    at = F.first(fits, ignorenulls=True).over(
        by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return rows.withColumn("target", F.least(F.col("_cap"), at * F.col("weight"))).select(
        "_no_source", "_source", "source_size", "weight", "slope", "target")


def _position(place: Column) -> Column:
    """The time at which the cumulative demand of a source reaches the share
    ``place`` of its target: the inverse of t + slope * (t*t - t)."""
    slope = F.col("slope")
    back = 1 - slope
    root = F.sqrt(back * back + 4 * slope * place)
    return F.when(slope == 0, place).otherwise((root - back) / (2 * slope))


def plan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
         source: str = "source", keep: list[str] | None = None) -> DataFrame:
    """Per document: ``keep``, size, source_size, target, copies, taken, and
    ``position`` of its first copy (null if it isn't taken)."""
    keep = [doc_id] if keep is None else keep
    rows = docs.select(*[F.col(f"`{c}`").alias(f"k_{i}") for i, c in enumerate(keep)],
                       *_keys(docs, doc_id, text, source))
    buckets = checkpointed(rows.groupBy("_no_source", "_source", "_bucket")
                           .agg(F.sum("_size").alias("_in_bucket")))
    targets = source_targets(buckets.groupBy("_no_source", "_source")
                             .agg(F.sum("_in_bucket").alias("source_size")))
    in_order = Window.partitionBy("_no_source", "_source").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = checkpointed(
        buckets.withColumn("_start", F.coalesce(F.sum("_in_bucket").over(in_order), F.lit(0)))
        .join(targets, ["_no_source", "_source"]).drop("_in_bucket"))
    key = ["_no_source", "_source", "_bucket"]
    within = Window.partitionBy(*key).orderBy("_order").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.join(starts, key).withColumn(
        "_before", F.col("_start") + F.coalesce(F.sum("_size").over(within), F.lit(0)))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    epochs = F.floor(ratio).cast("bigint")
    left = F.col("target") - epochs * F.col("source_size")
    # the last epoch stops at the target, inside a document as a rule
    part = F.greatest(F.lit(0), F.least(F.col("_size"), F.floor(left) - F.col("_before")))
    copies = epochs + F.when(F.col("_before") + F.col("_size") / 2.0 < left, 1).otherwise(0)
    place = F.least(F.col("_before") / F.col("target"), F.lit(1.0))
    return rows.withColumn("copies", copies.cast("int")).select(
        *[F.col(f"k_{i}").alias(c) for i, c in enumerate(keep)],
        F.col("_size").alias("size"), "source_size", "target", "copies",
        (F.col("_size") * epochs + part).cast("bigint").alias("taken"),
        F.when((F.col("copies") > 0) & (F.col("target") > 0), _position(place)).alias("position"),
        "slope", "_before", "_order")


def mixed(docs: DataFrame) -> DataFrame:
    """The mix: one row per document, range-sorted by its first position."""
    rows = plan(docs).orderBy(F.col("position").asc_nulls_last(), "_order")
    return rows.select("doc_id", "size", "source_size", "target", "taken", "copies", "position")


def training_order(docs: DataFrame) -> DataFrame:
    """The taken copies with all their columns, range-sorted by position."""
    docs = docs.select(F.struct("*").alias("row"), "doc_id", "text", "source")  # no name can clash
    rows = plan(docs, keep=["row"]).filter("copies > 0")
    rows = rows.withColumn("_epoch", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    place = (F.col("_epoch") * F.col("source_size") + F.col("_before")) / F.col("target")
    at = F.when(F.col("target") > 0, _position(F.least(place, F.lit(1.0)))).otherwise(0.0)
    return rows.withColumn("_at", at).orderBy("_at", "_order", "_epoch").select("row.*")


_D = repr(float(MAX_REPEATS))
_PLACE = "(CASE place % {n} " + " ".join(f"WHEN {i} THEN {{{i}}}" for i in range(len(WEIGHTS))) + " END)"


def _cycle(values) -> str:
    return _PLACE.format(*[f"CAST({float(v)!r} AS DOUBLE)" for v in values], n=len(WEIGHTS))


#: The same rows in DuckDB SQL.
ORACLE = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS o
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM d GROUP BY source),
w AS (SELECT *, {_cycle(WEIGHTS)} AS weight, {_cycle(SLOPES)} AS slope, {_D} * source_size AS cap FROM s),
l AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE)
                 - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
                            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
g AS (SELECT min(level) AS level FROM (SELECT level FROM l WHERE level * weight <= cap
                                       ORDER BY cap / weight, source NULLS LAST LIMIT 1)),
t AS (SELECT source, source_size, slope, least(cap, g.level * weight) AS target FROM l, g),
c AS (SELECT doc_id, size, source_size, target, slope,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY o
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
             CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
k AS (SELECT *, CAST(epochs + CASE WHEN before + size / 2.0 < target - epochs * source_size
                              THEN 1 ELSE 0 END AS INTEGER) AS copies,
             least(before / target, 1.0) AS p,
             size * epochs + greatest(0, least(size, CAST(floor(target - epochs * source_size) AS BIGINT)
                                                     - before)) AS taken FROM c)
SELECT doc_id, size, source_size, target, CAST(taken AS BIGINT) AS taken, copies,
       CASE WHEN copies > 0 AND target > 0 THEN
            CASE WHEN slope = 0 THEN p
                 ELSE (sqrt((1 - slope) * (1 - slope) + 4 * slope * p) - (1 - slope)) / (2 * slope) END
       END AS position
FROM k"""
