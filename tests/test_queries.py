"""Every registered query against its SQL on the same tables."""

import os

import pytest

import __spark_entry__ as entry
from rosterlake.catalog import ORACLES, QUERIES
from tools.compare import canonical, connect, expected, found

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(name, spark, con):
    mine = found(entry.queries()[name](spark, FOLDER))
    theirs = expected(con, entry.oracle_sql()[name])
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert canonical(mine) == canonical(theirs)


def test_entry(spark):
    result = entry.entry(spark)
    assert result.count() > 0
    assert result.columns[0] == "id"
