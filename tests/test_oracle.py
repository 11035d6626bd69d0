"""Every registered query against its independent SQL, row for row."""

from __future__ import annotations

import pytest
from compare import differences, duck

import __spark_entry__ as contract

ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck("/root/testdata/sf0.001")


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, sf_dir, name):
    assert differences(contract.queries()[name](spark, sf_dir), con, ORACLES[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0
