"""Queries against their SQL twins."""

import oracle_check
import pytest

from marketstream.llm import oracles, queries


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_query_matches_twin(spark, sf_dir, name):
    result = queries.QUERIES[name](spark, sf_dir)
    assert oracle_check.difference(result, oracle_check.connect(sf_dir), oracles.ORACLES[name]) is None
