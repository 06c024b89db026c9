"""Every query against its SQL on whole tables."""

import pytest

import __spark_entry__ as entry_point
from compare import connect, differences
from tidemark.workload.oracle import SQL
from tidemark.workload.queries import QUERIES

UNCHECKED = {"q_ml_scores", "q_model_search"}


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


def test_every_query_has_sql():
    assert QUERIES.items() <= entry_point.queries().items()
    assert {k: v for k, v in SQL.items() if k in QUERIES}.items() <= entry_point.oracle_sql().items()
    assert set(QUERIES) - set(SQL) == UNCHECKED
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, folder, con, name):
    assert differences(QUERIES[name](spark, folder), con, SQL[name]) == []


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["month", "n", "positive_rate"]
    assert df.count() > 0
