"""Reading the source tables.

``read_source`` returns the canonical column list of a table: columns
present in the file are passed through (Catalyst prunes the unused ones at
the scan), missing ones become typed NULL literals (constant-folded, no I/O).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finmart.sources.schemas import SOURCE_COLUMNS
from finmart.sources.storage import path_exists

# Fixed values of the partsupp stand-in (the delivered test data has no
# partsupp table): unit cost = ((partkey*31 + suppkey*17) % 9901 + 100) cents.
STANDIN_PART_FACTOR = 31
STANDIN_SUPP_FACTOR = 17
STANDIN_MODULUS = 9901
STANDIN_OFFSET_CENTS = 100


def align_source(df: DataFrame, name: str) -> DataFrame:
    """Project ``df`` onto the canonical columns of source ``name``."""
    present = set(df.columns)
    cols = [F.col(c) if c in present else F.lit(None).cast(t).alias(c)
            for c, t in SOURCE_COLUMNS[name]]
    return df.select(*cols)


def partsupp_standin(lineitem: DataFrame) -> DataFrame:
    """One partsupp row per distinct (l_partkey, l_suppkey) of lineitem.

    The cost is a deterministic function of the pair, 1.00 .. 100.00.
    ``distinct`` is a map-side-combined aggregation, so a hot pair costs one
    row per partition before the shuffle.
    """
    pairs = lineitem.select(F.col("l_partkey").alias("ps_partkey"),
                            F.col("l_suppkey").alias("ps_suppkey")).distinct()
    cents = ((F.col("ps_partkey") * STANDIN_PART_FACTOR + F.col("ps_suppkey") * STANDIN_SUPP_FACTOR)
             % STANDIN_MODULUS + STANDIN_OFFSET_CENTS)
    cost = (cents.cast("decimal(14,0)") / F.lit(100)).cast("decimal(12,2)")
    return align_source(pairs.withColumn("ps_supplycost", cost), "partsupp")


def read_source(spark: SparkSession, sf_dir: str, name: str,
                standin_costs: bool = False) -> DataFrame:
    """Scan one source table by logical name, aligned to its canonical columns.

    A missing partsupp is an error, unless ``standin_costs`` asks for made-up
    unit costs; whether it is missing is asked of the file system Spark uses.
    """
    if name not in SOURCE_COLUMNS:
        raise KeyError(f"unknown source table {name!r}")
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if name == "partsupp" and not path_exists(spark, path):
        if not standin_costs:
            raise FileNotFoundError(f"{path} is not there; standin_costs would make up its costs")
        return partsupp_standin(read_source(spark, sf_dir, "lineitem"))
    return align_source(spark.read.parquet(path), name)


@dataclass
class Sources:
    """Lazily-read source tables of one data directory."""

    spark: SparkSession
    sf_dir: str
    standin_costs: bool = False
    _cache: dict = field(default_factory=dict)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = read_source(self.spark, self.sf_dir, name, self.standin_costs)
        return self._cache[name]
