"""Every registered query against its SQL on the smallest driver tables."""

from __future__ import annotations

import os

import pytest
from oracle import connect, differences

import __spark_entry__ as entry
from meetlake.checks import registry

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables here")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.SQL)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) & set(entry.oracle_sql())))
def test_query(spark, con, name):
    frame = entry.queries()[name](spark, SF_DIR)
    assert differences(frame, con, entry.oracle_sql()[name]) == ""


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns[0] == "id"
    frame.collect()
