"""Every registered query against its SQL twin."""

import oracle_check
import pytest

import __spark_entry__
from marketstream import harness

QUERIES, ORACLES = harness.queries(), harness.oracle_sql()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return oracle_check.connect(sf_dir)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_twin(spark, sf_dir, connection, name):
    result = QUERIES[name](spark, sf_dir)
    assert oracle_check.difference(result, connection, ORACLES[name]) is None


def test_flagship_has_rows(spark):
    result = __spark_entry__.entry(spark)
    assert result.columns == ["product_id", "ts_utc", "time_ist", "price", "rolling_vwap"]
    assert result.count() > 0
