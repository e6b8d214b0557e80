"""The queries of this subpackage against their DuckDB oracles, on the smallest driver data."""

import pytest

from relaysql.llm.queries import ORACLES, QUERIES
from tests.oracle import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF), ORACLES[name], con)
    assert ok, msg
