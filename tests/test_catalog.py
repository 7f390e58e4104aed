"""Every query of the catalogue against DuckDB on the smallest data."""

import pytest

import __spark_entry__ as entry_points
from compare import connect, differences
from newsroster import catalog

FOLDER = entry_points.SMOKE_DATA
QUERIES = catalog.queries()
ORACLE = catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    found = differences(QUERIES[name](spark, FOLDER), duck, ORACLE[name])
    # A small table may leave a result empty; then both sides must be.
    assert [f for f in found if f != "no rows"] == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry_is_ranked(spark):
    rows = entry_points.entry(spark).orderBy("rank").collect()
    scores = [r["Relevance"] for r in rows]
    assert rows and scores == sorted(scores, reverse=True)
