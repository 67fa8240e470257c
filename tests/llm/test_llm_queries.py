"""Corpus queries against their SQL, and what every query has to give."""

import pytest

import __spark_entry__ as entry_module
import check
from graphfeed.llm import queries

SQL = sorted(queries.oracle_sql())


@pytest.mark.parametrize("name", SQL)
def test_query_matches_sql(spark, sf_dir, name):
    ok, note = check.compare(spark, check.duck(sf_dir), name, sf_dir)
    assert ok, note


def test_all_are_registered():
    names = entry_module.queries()
    assert set(queries.queries()) <= set(names) and "pipeline" in names
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
