"""Every query's result against SQL on the same files."""

import os
from pathlib import Path

import pytest

import __spark_entry__ as entry
from bazarlake.oracle.statements import all_statements
from bazarlake.registry import all_queries
from compare import connect, difference

SMALL = os.environ.get("BAZARLAKE_SF_DIR", "/root/testdata/sf0.001")
NAMES = tuple(all_statements())

pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="supplied tables not present")


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    assert difference(entry.queries()[name](spark, SMALL), duck, entry.oracle_sql()[name]) is None


def test_every_expected_result_has_a_query():
    assert set(all_statements()) == set(all_queries()) - {"dq_outlier_percentiles"}
