"""Every registered query against its SQL on the smallest data set."""

from __future__ import annotations

import os

import oracle
import pytest

import __spark_entry__ as entry
from lakeops import workloads

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
LARGER = os.environ.get("TEST_LARGER_SF_DIR", "/root/testdata/sf0.01")
QUERIES, SQL = workloads.queries(), workloads.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


def test_registry():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) - set(SQL) == {"lake_file_sizes", "script_suite_timing"}


def test_entry_has_them_all():
    assert QUERIES.items() <= entry.queries().items() and SQL.items() <= entry.oracle_sql().items()


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name not in SQL:
        assert df.count() > 0
        return
    problem = oracle.compare(df, con, SQL[name])
    if problem == "EMPTY":  # the smallest tables have no such row: the next larger ones must
        problem = oracle.compare(QUERIES[name](spark, LARGER), oracle.connect(LARGER), SQL[name])
    assert problem is None
