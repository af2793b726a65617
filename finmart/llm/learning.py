"""What the two classifiers share: the held-out rule and a bounded sample."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A document is held out of all learning where its id's CRC-32 is divisible by this.
FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Whether the labels of this document may not be learnt from (a row
    without id has no label, and isn't held out)."""
    fold = F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0
    return F.coalesce(fold, F.lit(False))


def training_ids(docs: DataFrame, labels: DataFrame, label: str, rows_per_class: int,
                 chars_per_class: int | None = None) -> list[tuple[int, int]]:
    """(doc_id, y): at most ``rows_per_class`` documents of each class that are there
    and labelled, outside the held-out fold, the first ones by a hash of the id.  A
    document with several labels counts with the largest, a repeated id once.
    ``chars_per_class`` bounds the characters of a class altogether: a document that
    would go beyond it is left out, whatever its length.  Only ids and lengths are
    looked at; at most twice ``rows_per_class`` of them reach the driver."""
    known = (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                           F.col(f"`{label}`").cast("int").alias("y"))
             .filter("doc_id IS NOT NULL AND y IN (0, 1)")
             .filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("y").alias("y")))
    sizes = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                        F.coalesce(F.length("text"), F.lit(0)).alias("chars"))
    found = sizes.join(known, "doc_id").groupBy("doc_id", "y").agg(F.max("chars").alias("chars"))
    first = Window.partitionBy("y").orderBy(F.xxhash64("doc_id"), "doc_id")
    rows = found.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= rows_per_class)
    out, left = [], {0: chars_per_class, 1: chars_per_class}
    for r in sorted(rows.collect(), key=lambda r: (r["y"], r["place"])):
        if chars_per_class is not None:
            if r["chars"] > left[r["y"]]:
                continue
            left[r["y"]] -= r["chars"]
        out.append((r["doc_id"], r["y"]))
    return out


def training_documents(docs: DataFrame, labels: DataFrame, label: str, rows_per_class: int,
                       chars_per_class: int | None = None) -> DataFrame:
    """doc_id, text (the least of a repeated id) and y of the sampled documents.  The
    broadcast holds at most twice ``rows_per_class`` ids."""
    ids = training_ids(docs, labels, label, rows_per_class, chars_per_class)
    # as an Arrow table: rows of Python would be unpacked by workers of another kind, which stay for a while
    columns = {"doc_id": pa.array([i for i, _ in ids], pa.int64()), "y": pa.array([y for _, y in ids], pa.int32())}
    sample = docs.sparkSession.createDataFrame(pa.table(columns), "doc_id bigint, y int")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return (texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id")
            .agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.max("y").alias("y")))
