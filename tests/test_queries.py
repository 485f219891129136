"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from checks.compare import same

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(name, spark, con, sf):
    verdict, _, _ = same(spark, con, QUERIES[name], ORACLES[name], sf)
    assert verdict.startswith("ok"), verdict


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(name, spark, sf):
    assert QUERIES[name](spark, sf).count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
