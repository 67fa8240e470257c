"""Each named query against its SQL in DuckDB."""

import pytest

import __spark_entry__ as entry_module
import check
from graphfeed.plans import registry


@pytest.fixture(scope="module")
def con(sf_dir):
    return check.duck(sf_dir)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_sql(spark, con, sf_dir, name):
    ok, note = check.compare(spark, con, name, sf_dir)
    assert ok, note


def test_every_query_has_sql():
    assert set(registry.queries()) == set(registry.oracle_sql())
    assert set(registry.queries()) <= set(entry_module.queries())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
