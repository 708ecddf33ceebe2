"""Every registered query against its SQL twin on the smallest tables."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"
#: The queries of the training-data subpackage have their own tests.
QUERIES = {name: run for name, run in entry.queries().items() if not re.match(r"op\d+_|pipeline$", name)}
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert ("Python" in plan or "MapInPandas" in plan) == name.startswith("p20")
    assert difference(df, duck, SQL[name]) is None


def test_entry_gives_regions(spark):
    assert 0 < entry.entry(spark).count() <= 5
