"""The registered queries of the operators, and their SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coldhaul.llm import (
    chat, fim, language, licenses, mixing, neardup, negatives, packing, pages, quality, sharding, suffixes, topk)
from coldhaul.llm.oracle import ORACLE_SQL as ORACLE_SQL


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, laid out by turn, and conversation -1, a prompt and response record."""
    record = spark.sql(r"""SELECT -1L AS conv_id, to_json(named_struct('prompt', '</s>[INST] ok [/INST]',
                                                            'response', '</s>[INST] ok [/INST]')) AS record""")
    turns = chat.turn_rows(_table(spark, sf_dir, "conversations"), "conv_id").unionByName(
        chat.canonical_turns(record, "conv_id", "record"))
    return chat.conversation_digests(chat.format_turns(turns))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"))


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"))


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.removal_digests(_table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(_table(spark, sf_dir, "documents"))
    return judged.withColumn("failed_rules", F.array_join("failed_rules", " "))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "copies")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op9_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return licenses.scan(docs, licenses.train(docs))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return language.identify(docs, language.train(docs))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(_table(spark, sf_dir, "embeddings"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.transform_digests(_table(spark, sf_dir, "documents"))


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(_table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_chat_formatting, op2_mixing, op3_sharding, op4_exact_top_k, op5_suffix_array_dedup, op6_quality_rules,
                                op7_ngram_jaccard_join, op8_best_fit_packing, op9_license_scans, op10_language_id, op11_hard_negatives,
                                op12_fill_in_middle, op13_html_extraction)}
