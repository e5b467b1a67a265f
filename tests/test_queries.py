"""Registered queries against their SQL on the smallest driver tables."""

import os

import pytest
from check_queries import connect, differences

import __spark_entry__ as entry
from tagtide.plans import oracles, registry

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def tables():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(registry.queries()) == set(oracles.oracle_sql())


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query_equals_sql(spark, tables, name):
    assert differences(spark, tables, SF_DIR, name) is None


def test_entry(spark):
    found = entry.entry(spark)
    assert found.columns == ["date_recorded", "rank", "hashtag", "rt_count", "avg_sentiment", "date_posted"]
    assert found.count() > 0
