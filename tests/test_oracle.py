"""Every registered query against its SQL on the smallest data."""

import pytest
from compare import connect, difference

from __spark_entry__ import entry
from skyledger.catalog import QUERIES
from skyledger.oracles import ORACLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, ORACLES[name]) is None


def test_entry(spark):
    assert entry(spark).count() > 0
