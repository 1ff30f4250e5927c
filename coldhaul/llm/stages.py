"""The stages of the corpus pipeline: (spark, documents, sf_dir) to a DataFrame.

All take any table with the columns of documents, and hand on further columns, whatever their names, with the rows they keep. Null
ids are kept as they are. A null text counts as empty; rows that repeat others count as documents of their own. Texts are
read whole at any length. An empty table gives an empty table of the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coldhaul.llm import mixing, neardup, packing, quality, suffixes
from coldhaul.llm.common import bound


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base and every rule of the threshold table, unchanged.

    A null or empty text has too few words and goes.
    """
    return docs.filter(bound(quality.measures(F.col("text")), lambda m: quality.passes(m)))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, unchanged.

    It is the one of the least id, a null id coming last; of equal rows one stays. Texts without a word are classes of their own.
    """
    return neardup.first_of_each(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that repeat.

    A null text stays null; a text that is repeated whole becomes empty.
    """
    return suffixes.without_repeats(docs)


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often and as far as it takes them.

    A document without a word is in no mix. A null source is a source of its own, the last one.
    """
    return mixing.mixed_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents.

    Only here do other columns go. A null or empty text is the closing id alone.
    """
    return packing.pack_documents(docs)


STAGES = [("quality_rules", quality_rules), ("ngram_jaccard_join", ngram_jaccard_join),
          ("suffix_array_dedup", suffix_array_dedup), ("mixing", mixing_weights), ("best_fit_packing", best_fit_packing)]
