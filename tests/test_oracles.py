import pytest

from plyforge.plans import QUERIES, SQL
from tests.oracle import compare, connection


@pytest.fixture(scope="module")
def con(sf_dir):
    return connection(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    if name in SQL:
        assert compare(df, con, SQL[name]) is None
    else:
        df.collect()
