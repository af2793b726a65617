"""Connected components of a graph given as an edge table.

Alternating star steps: in the large-star step every node ties its larger
neighbours to its smallest one, in the small-star step its smaller neighbours
and itself.  Edges only ever shrink towards the smallest node of a component,
until each component is one star around it.  A step is an aggregation and a
join by node, so a hub is an ordinary skewed key (the minimum is combined on
the map side, the join's partition can be split); nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finmart.llm.common import checkpointed


def _mirrored(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(neighbours: DataFrame, large: bool) -> DataFrame:
    """One star step over (a, b): ``a``'s neighbours ``b`` go to the least of both."""
    least = checkpointed(neighbours.groupBy("a").agg(F.min("b").alias("m"))
                         .select("a", F.least("a", "m").alias("m")))
    joined = neighbours.join(least, "a")
    if large:
        out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b: not null); the
    component is its smallest node."""
    edges = checkpointed(edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        digest = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")),
                           F.sum(F.hash("a", "b").cast("bigint"))).first()
        if digest == seen or not digest[0]:
            break
        seen = digest
        stars = checkpointed(_star(_mirrored(edges), large=True))
        edges = checkpointed(_star(stars.select(F.greatest("a", "b").alias("a"),
                                                F.least("a", "b").alias("b")), large=False))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
