"""Every registered query against its SQL oracle."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import check

TESTDATA = "/root/testdata/sf0.01"

ORACLES = entry.oracle_sql()
QUERIES = entry.queries()
# Whole builds and models have tests of their own.
SLOW = {"m2_feature_matrix", "pipeline"}


@pytest.fixture(scope="module")
def duck():
    return check.connect(TESTDATA)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query_matches_oracle(spark, duck, name):
    assert check.compare(spark, duck, name, QUERIES[name], ORACLES.get(name), TESTDATA) is None


def test_whole_matrix_matches_oracle(spark, duck):
    name = "m2_feature_matrix"
    assert check.compare(spark, duck, name, QUERIES[name], ORACLES[name], TESTDATA) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
