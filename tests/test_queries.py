import pytest

from checks import all_oracles, all_queries
from checks.compare import connect, differences
from tests.conftest import SMALL

QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, connection, name):
    assert differences(spark, connection, SMALL, name, QUERIES[name], ORACLES.get(name)) == ""
