"""Every registered query against its SQL, at the smallest scale."""

import pytest
from compare import compare, connect
from conftest import SMALL

from tidemark.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    frame = QUERIES[name](spark, SMALL)
    if name in ORACLES:
        assert compare(frame, connection, ORACLES[name]) is None
    else:
        assert frame.count() >= 0


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
