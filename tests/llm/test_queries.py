import pytest
from conftest import same_as_sql

from shardloom.llm import queries


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_match_sql(spark, name):
    same_as_sql(spark, name, queries)
