"""Queries with SQL against DuckDB on the smallest data."""

import pytest

from compare import connect, differences
from newsroster.llm import catalog

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_equals_sql(spark, duck, name):
    assert differences(catalog.QUERIES[name](spark, FOLDER), duck, catalog.ORACLE[name]) == []
