import pytest

from plyforge.llm import queries
from tests.oracle import compare, connection


@pytest.fixture(scope="module")
def con(sf_dir):
    return connection(sf_dir)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query(spark, sf_dir, con, name):
    assert compare(queries.QUERIES[name](spark, sf_dir), con, queries.SQL[name]) is None
