"""Queries with a SQL twin, on the smallest tables."""

import pytest

from checks.compare import TABLES, _cell, connect
from coldhaul.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.conftest import SF_DIR


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_operator_has_one_query():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert set(ORACLE_SQL) <= set(QUERIES) and "documents" in TABLES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equals_twin(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    cursor = duck.execute(ORACLE_SQL[name])
    theirs_columns = [d[0] for d in cursor.description]
    assert sorted(theirs_columns) == columns
    order = [theirs_columns.index(c) for c in columns]
    theirs = sorted(tuple(_cell(r[i]) for i in order) for r in cursor.fetchall())
    ours = sorted(tuple(_cell(x) for x in r) for r in df.select(*columns).collect())
    assert ours == theirs
