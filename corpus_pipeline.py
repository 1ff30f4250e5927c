"""The corpus pipeline: stages of ``documents``, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from coldhaul.llm import stages
from coldhaul.session import cut

STAGES = stages.STAGES

#: The stages remove passages of texts and run a tokenizer, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
