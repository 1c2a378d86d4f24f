"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from check import compare, connect
from phonolake.plans import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    ok, note = compare(spark, con, name, SF_DIR)
    assert ok, note


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.count() > 0
    assert rows.columns[0] == "speaker"
