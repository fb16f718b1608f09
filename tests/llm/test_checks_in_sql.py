import pytest
from check import compare, connect

from wayfold.llm import queries


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_and_sql_agree(spark, small, name):
    assert compare(spark, connect(small), small, queries.QUERIES[name], queries.SQL[name]) is None
