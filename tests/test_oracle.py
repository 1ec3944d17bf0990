"""Every registered query against its SQL twin, over whole tables."""

import os

import pytest

from checks.compare import differences, duck
from checks.oracle import oracle_sql
from checks.registry import queries

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_a_twin():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_rows(spark, con, name):
    assert differences(queries()[name](spark, FOLDER), con, oracle_sql()[name]) is None


def test_entry_runs(spark):
    from __spark_entry__ import entry

    found = entry(spark)
    assert found.columns == ["i_category", "cnt"] and found.count() > 0
