"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as spark_entry
from parityframe.plans.catalog import QUERIES
from tests.conftest import SF
from tools.check_oracles import compare, connect

ROWS_ONLY = {"sample_bernoulli", "sample_stratified"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("key", list(spark_entry.queries()))
def test_query_matches_sql(spark, con, key):
    assert compare(spark, con, key, SF) is None


def test_only_random_samples_lack_sql():
    assert set(QUERIES) - set(spark_entry.oracle_sql()) == ROWS_ONLY
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


def test_entry(spark):
    df = spark_entry.entry(spark)
    assert df.columns[:4] == ["country", "country_name", "year", "gini"] and df.count() > 0
