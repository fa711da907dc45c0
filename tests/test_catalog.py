"""Every registered query against its SQL on the smallest test tables."""

import os

import pytest

from __spark_entry__ import entry
from setwise.plans.catalog import QUERIES
from setwise.plans.oracles import ORACLES

DATA = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    import compare

    return compare.connect(DATA)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    import compare

    assert compare.difference(spark, con, name, DATA) is None


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


def test_the_flagship_has_rows(spark):
    assert not entry(spark).isEmpty()
