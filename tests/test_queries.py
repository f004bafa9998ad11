"""Every registered query against its SQL on the smallest tables."""

from pathlib import Path

import oracle
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="the star tables are not here")


@pytest.fixture(scope="module")
def connection():
    return oracle.duck(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_equals_sql(spark, connection, name):
    assert oracle.compare(spark, FOLDER, name, entry.queries(), entry.oracle_sql(), connection) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
