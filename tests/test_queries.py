"""Every registered query against its SQL, on the smallest data set."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_points
from check_oracles import compare, connect

SF_DIR = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="test data not present")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry_points.queries()))
def test_query_agrees_with_sql(spark, connection, name):
    assert compare(spark, connection, name, str(SF_DIR)) is None


def test_every_oracle_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() == 6
