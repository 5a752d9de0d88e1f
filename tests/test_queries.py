"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
import oracle

SF_DIR = os.environ.get("TEST_SF_DIR", entry.SMOKE_DIR)


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(entry.core_queries()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(entry.core_queries()))
def test_query(spark, duck, name):
    found = entry.queries()[name](spark, SF_DIR)
    assert oracle.differences(found, duck, entry.oracle_sql()[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
