"""The corpus pipeline: from raw documents to packed training sequences.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet in the cluster's shared folder and gives the next stage
what it reads back.  All stages but the last return the columns of documents.

Defined results of the stages, whatever the rows: null and empty texts are texts
without words (the classifiers judge them like any other; they are near copies of
each other; the mix takes no copy of a source that has no words at all; packed they
are an end token).  Texts of any length are read whole.  Repeated rows and ties are
told apart where it matters: each is judged, one of a group of copies stays, the
mix and the packing count each row.  doc_id, lang and source may be null (the null
source is a source of its own).  Extra columns pass through the first four stages
and may have any name.  An empty table gives an empty table.

The mix ends in training order: its files hold the copies by position, the packing
numbers its sequences by the least position in them.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from finmart.llm import mixing, packing, quality_rules, simhash_dedup, toxicity_cnn
from finmart.llm.common import small_batches, table, workers_find_package
from finmart.session import ensure_checkpoint_dir
from finmart.sources.storage import delete_folder


def _prepare(spark: SparkSession) -> None:
    workers_find_package(spark)
    small_batches(spark)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    _prepare(spark)
    return quality_rules.keep_good(docs, quality_rules.fit(docs, table(spark, sf_dir, "labels")))


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    _prepare(spark)
    return toxicity_cnn.keep_clean(docs, toxicity_cnn.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    _prepare(spark)
    return simhash_dedup.keep_one_of_each(docs)


def mix_of_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The copies that the mix takes, in training order."""
    _prepare(spark)
    return mixing.training_order(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed in sequences that are numbered in training
    order: the order of the files that hold ``docs`` (documents from elsewhere have
    none)."""
    _prepare(spark)
    placed, position = packing.in_file_order(docs)
    return packing.packed(placed, public_tokenizers.path("byte_bpe_50k.json"), position=position)


STAGES = [
    ("quality classifier", good_quality),
    ("toxicity", not_toxic),
    ("SimHash near-dedup", near_duplicates_out),
    ("mixing sources to target weights", mix_of_sources),
    ("best-fit packing", packed_sequences),
]

#: The classifiers and the tokenizer can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
        if i:  # nothing reads the stage before any more
            delete_folder(spark, f"{folder}/{i - 1}")
    return docs
