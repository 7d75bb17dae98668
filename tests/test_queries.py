"""Every registered query at the smallest scale against its SQL."""

import os

import pytest

import __spark_entry__ as entry
from capledger.checks.registry import ORACLES, QUERIES
from tests.compare import connect, difference

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(ROOT):
        pytest.skip("benchmark tables not present")
    return connect(ROOT)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    assert difference(entry.queries()[name](spark, ROOT), con, entry.oracle_sql()[name]) is None


def test_flagship(spark):
    if not os.path.isdir(ROOT):
        pytest.skip("benchmark tables not present")
    assert entry.entry(spark).count() > 0
