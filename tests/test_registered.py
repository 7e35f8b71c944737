"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest
from compare import connect, difference

from __spark_entry__ import entry
from workload import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_names():
    assert set(ORACLE) == set(QUERIES)


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, ORACLE[name]) is None
