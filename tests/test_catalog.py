"""Every registered query against its DuckDB oracle, on the smallest driver data."""

import pytest

import __spark_entry__ as entry
from relaysql.plans.catalog import ORACLES, QUERIES
from tests.oracle import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["value"] and df.count() > 0


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF), ORACLES[name], con)
    assert ok, msg


def test_entry_registers_them_all():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
