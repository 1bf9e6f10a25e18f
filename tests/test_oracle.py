"""Every registered query against its DuckDB text, over the whole small tables."""

from functools import partial

import pytest

import __spark_entry__ as spark_entry
from conftest import SAMPLE
from duck_oracle import oracles
from oracle_check import connect, difference
from pricelake.queries import QUERIES as BUILDERS, run

QUERIES, TEXTS = {name: partial(run, name) for name in BUILDERS}, oracles()


@pytest.fixture(scope="module")
def con():
    return connect(SAMPLE)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(TEXTS)
    assert set(QUERIES) <= set(spark_entry.queries()) and set(TEXTS) <= set(spark_entry.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_same_result(spark, con, name):
    assert difference(QUERIES[name](spark, SAMPLE), con, TEXTS[name]) is None


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0
