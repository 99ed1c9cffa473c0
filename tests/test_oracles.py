"""Every registered query against its SQL on the smallest tables."""

import pytest

from playlens.plans import registry
from tests.compare import compare, connect
from tests.conftest import SMALL

registry.load()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_same_rows_as_sql(spark, con, name):
    problem, _ = compare(spark, con, registry.QUERIES[name], registry.ORACLES[name], SMALL)
    assert problem is None, problem


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)
