import os

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from coldhaul.session import build_session

# extra columns that clash with names the operators use themselves
DOCUMENTS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()),
                        StructField("lang", StringType()), StructField("source", StringType()),
                        StructField("n_chars", LongType()), StructField("size", StringType()),
                        StructField("slot", StringType()), StructField("rank", StringType()),
                        StructField("_id", StringType()), StructField("bytes", StringType())])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("coldhaul-llm-tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.log.level": "ERROR",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    yield session


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a table of documents from (doc_id, text[, lang, source]) rows."""
    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s",
                 None if r[1] is None else len(r[1]), "x", "y", "z", "w", "v") for r in rows]
        return spark.createDataFrame(full, DOCUMENTS)
    return make


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def prose(rng, n, vocabulary=400):
    """``n`` invented words."""
    return " ".join(f"w{int(x)}" for x in rng.integers(0, vocabulary, n))


SF_DIR = os.environ.get("COLDHAUL_SF", "/root/testdata/sf0.001")
