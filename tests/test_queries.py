"""Every registered query against its SQL oracle."""

import pytest

import __spark_entry__ as entry
from oracle import SF_DIR, compare, connect

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, duck, name):
    assert compare(spark, duck, QUERIES[name], ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert len(QUERIES[name](spark, SF_DIR).take(1)) == 1


def test_oracles_have_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).columns == ["estimate", "stderr", "t_statistic", "p_value", "lower", "upper"]
