"""Registered queries of the training-data operators at the smallest scale against their SQL."""

import os

import pytest

from capledger.llm.queries import ORACLES, QUERIES
from tests.compare import connect, difference

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(ROOT):
        pytest.skip("benchmark tables not present")
    return connect(ROOT)


def test_sql_belongs_to_queries():
    assert set(ORACLES) <= set(QUERIES)
    assert [name.split("_")[0] for name in QUERIES][:13] == [f"op{n}" for n in range(1, 14)]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, con, name):
    assert difference(QUERIES[name](spark, ROOT), con, ORACLES[name]) is None
