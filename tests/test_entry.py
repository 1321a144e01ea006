"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from check_oracle import compare, connect

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["player_name", "form", "career_avg"] and df.count() == 15


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_sql(spark, con, name):
    verdict, _, _ = compare(spark, con, entry.queries()[name], entry.oracle_sql().get(name), SF)
    # at this scale some results are rightly empty on both sides
    assert verdict in ("same", "same (EMPTY)", "rows only"), verdict
