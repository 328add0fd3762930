"""Every catalogue query against its SQL twin on the smallest data."""

import pytest
from check import compare, connect
from conftest import SF

from recoflow.plans import oracles
from recoflow.plans.catalog import QUERIES

ORACLES = oracles.sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, SF), duck, ORACLES[name]) is None


def test_entry(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.columns == ["user_id", "channel_id", "topic", "weight", "rank"]
    assert df.count() > 0
