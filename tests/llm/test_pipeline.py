"""The corpus pipeline and the entry points."""

import numpy as np

import __spark_entry__
import corpus_pipeline
from coldhaul.llm import neardup, quality, stages, suffixes
from coldhaul.session import cut
from tests.llm.conftest import SF_DIR, prose


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "ngram_jaccard_join", "suffix_array_dedup", "mixing", "best_fit_packing"]
    judged = {r.doc_id for r in quality.judge(docs).filter("kept").collect()}
    first = cut(stages.quality_rules(spark, docs, SF_DIR), "s")
    assert {r.doc_id for r in first.collect()} == judged and first.columns == docs.columns
    second = cut(stages.ngram_jaccard_join(spark, first, SF_DIR), "s")
    assert {r.doc_id for r in second.collect()} == {r.class_id for r in neardup.near_duplicates(first).collect()}
    third = cut(stages.suffix_array_dedup(spark, second, SF_DIR), "s")
    assert third.count() == second.count() and suffixes.removal_digests(third).agg({"n_removed": "sum"}).first()[0] is not None
    fourth = stages.mixing_weights(spark, third, SF_DIR)
    assert fourth.columns == third.columns == second.columns == docs.columns


def odd_documents(documents):
    """Nulls in every column, empty and long texts, repeated rows, near copies, a shared passage, clashing column names."""
    rng = np.random.default_rng(20)

    def text(n):
        return "the " + " of the ".join(prose(rng, 6, 4000) for _ in range(n // 8))

    shared = text(120)
    given = [(i, f"{text(160)}\n{shared}\n{text(160)}", "en", ["a", "b", None][i % 3]) for i in range(30)]
    given += [(100, None), (101, ""), (102, " \n\t"), (None, text(200)), (None, None), (103, text(60_000), None, None), given[3], given[3],
              (104, given[5][1]), (105, given[6][1] + " more"), (106, "x" * 300_000), (107, "\U0001f600\u00e9 " * 400)]
    return documents(given), given


def test_odd_rows_through_all_stages(spark, documents):
    docs, given = odd_documents(documents)
    held = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        held[name] = cut(stage(spark, docs, SF_DIR), name)
        assert held[name].columns == docs.columns, name
        docs = held[name]
    kept = [r.doc_id for r in held["quality_rules"].collect()]
    assert {100, 101, 102, 106} & set(kept) == set() and {0, 103, 104, None} <= set(kept) and kept.count(3) == 3
    one = [r.doc_id for r in held["ngram_jaccard_join"].collect()]
    # copies and near copies are one document, that of the least id
    assert one.count(3) == 1 and not {104, 105} & set(one) and {5, 6, 103, None} <= set(one)
    cut_down = {r.doc_id: r.text for r in held["suffix_array_dedup"].collect()}
    passage = given[0][1].split("\n")[1]
    assert len(cut_down) == len(one) and not any(passage in (t or "") for t in cut_down.values())
    assert cut_down[103] == given[35][1]
    mixed = held["mixing"].groupBy("source").count().collect()
    assert {r.source for r in mixed} <= {"a", "b", None, "s"} and len(mixed) >= 3
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_empty_table_through_all_stages(spark, documents):
    docs = documents([])
    for name, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, SF_DIR), name)
        assert docs.count() == 0, name


def test_run_gives_the_packed_pieces(spark):
    found = corpus_pipeline.run(spark, SF_DIR)
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert found.count() > 0 and found.groupBy("sequence_id").sum("length").filter("`sum(length)` > 2048").count() == 0


def test_registered(spark):
    queries = __spark_entry__.queries()
    assert "pipeline" in queries and "op7_ngram_jaccard_join" in queries
    assert set(__spark_entry__.oracle_sql()) <= set(queries) and corpus_pipeline.ORACLE_SQL is None
