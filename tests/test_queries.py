"""Every registered query against its SQL on the smallest tables."""

import pytest

from riskloom.catalog import ORACLES, QUERIES
from tests.conftest import SF
from tools.check_queries import compare, connect


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    ok, text = compare(spark, con, name, SF)
    assert ok, text


def test_every_sql_has_its_query():
    assert set(ORACLES) <= set(QUERIES)
