"""Every registered query against its SQL twin, on whole tables."""

import pytest

import __spark_entry__ as contract
from tests.compare import check, duck


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


# The optional queries have tests of their own.
NAMES = [n for n in contract.queries() if n not in contract.LLM_QUERIES]


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_sql(spark, con, sf_dir, name):
    assert check(spark, con, name, sf_dir) is None


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_has_rows_and_a_stable_schema(spark):
    a, b = contract.entry(spark), contract.entry(spark)
    assert a.schema == b.schema
    assert a.count() > 0
