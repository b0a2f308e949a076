"""Every registered query against DuckDB on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from check_oracles import connect, differences
from conftest import SF_DIR

ORACLES = contract.oracle_sql()
QUERIES = contract.queries()


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, db, name):
    assert differences(QUERIES[name](spark, SF_DIR), db, ORACLES[name]) is None


def test_names():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).count() == 2
