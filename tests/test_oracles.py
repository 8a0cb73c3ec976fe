"""Every registered query against its SQL twin, on the smallest tables."""

import os

import pytest

from starloom.queries import ORACLES, QUERIES
from tests.oracle import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    difference, _ = compare(spark, con, name, SF_DIR)
    assert difference in ("", "no rows")
