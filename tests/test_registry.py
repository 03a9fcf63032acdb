"""Every registered query against its oracle SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
from alignlake import registry
from alignlake.registry.check import difference

QUERIES, ORACLES = registry.queries(), registry.oracles()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_entry_runs(spark):
    df = contract.entry(spark)
    assert df.columns == ["band", "chats", "avg_quality", "avg_length"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), sf_dir, ORACLES[name]) is None
