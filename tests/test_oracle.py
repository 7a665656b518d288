"""Every registered query against its SQL on the given tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as registered
from compare import connect, differences
from podium.catalog import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    sql = registered.oracle_sql().get(name)
    frame = registered.queries()[name](spark, SF_DIR)
    if sql is None:
        assert frame.count() > 0
    else:
        assert differences(frame, duck, sql) is None


def test_every_sql_has_its_query():
    assert set(registered.oracle_sql()) <= set(registered.queries())


def test_entry(spark):
    assert registered.entry(spark).count() > 0
