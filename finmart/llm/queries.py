"""The registered queries of the training-data operators: name -> query, and
the SQL of those that SQL can express."""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from finmart.llm.common import table, workers_find_package

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(f):
    @functools.wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        workers_find_package(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return run


@query
def op4_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    from finmart.llm.chat_tools import TOOLS, link_tool_calls, with_tool_messages
    return link_tool_calls(with_tool_messages(table(spark, sf_dir, "conversations")), TOOLS)


@query
def op5_rabitq_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from finmart.llm.rabitq_dedup import near_duplicate_vectors
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from finmart.llm.token_counts import token_counts
    return token_counts(table(spark, sf_dir, "documents"),
                        public_tokenizers.path("word_bpe_49k.json"), limit=2048)


@query
def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    from finmart.llm.html_extract import extract_main_text
    return extract_main_text(table(spark, sf_dir, "pages"))


@query
def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from finmart.llm.simhash_dedup import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from finmart.llm.packing import packed
    return packed(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op7_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    from finmart.llm import toxicity_cnn
    docs = table(spark, sf_dir, "documents")
    return toxicity_cnn.score(docs, toxicity_cnn.fit(docs, table(spark, sf_dir, "labels")))


@query
def op8_simhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from finmart.llm.fingerprints import fingerprinted, with_near_counts
    return with_near_counts(fingerprinted(table(spark, sf_dir, "documents")))


@query
def op9_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from finmart.llm.mixing import mixed
    return mixed(table(spark, sf_dir, "documents"))


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from finmart.llm import quality_rules
    docs = table(spark, sf_dir, "documents")
    return quality_rules.score(docs, quality_rules.fit(docs, table(spark, sf_dir, "labels")))


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from finmart.llm.hard_negatives import mine
    return mine(table(spark, sf_dir, "embeddings"))


@query
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from finmart.llm.source_audit import source_divergence
    return source_divergence(table(spark, sf_dir, "documents"))


@query
def op13_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    from finmart.llm.secret_ledger import document_secrets
    return document_secrets(table(spark, sf_dir, "documents"))


def _oracles() -> None:
    from finmart.llm import chat_tools, hard_negatives, mixing, secret_ledger, source_audit
    ORACLE_SQL["op11_hard_negatives"] = hard_negatives.ORACLE
    ORACLE_SQL["op12_source_divergence"] = source_audit.ORACLE
    ORACLE_SQL["op13_secret_ledger"] = secret_ledger.ORACLE
    ORACLE_SQL["op4_tool_call_linking"] = chat_tools.ORACLE
    ORACLE_SQL["op9_curriculum_mix"] = mixing.ORACLE


_oracles()
