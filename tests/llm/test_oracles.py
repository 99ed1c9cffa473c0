"""Every query with SQL against it, on the smallest tables."""

import pytest

from playlens.llm import queries
from tests.compare import compare, connect
from tests.conftest import SMALL


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows_as_sql(spark, name):
    problem, _ = compare(spark, connect(SMALL), queries.QUERIES[name], queries.ORACLES[name], SMALL)
    assert problem is None, problem
