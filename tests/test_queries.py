"""Every registered query against its checking SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from coverledger.queries import QUERIES
from tests.compare import compare

SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in QUERIES}


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches(spark, con, sf_dir, name):
    ok, note = compare(spark, con, name, QUERIES[name], SQL[name], sf_dir)
    assert ok, note


def test_entry_runs(spark):
    rows = entry.entry(spark).collect()
    assert rows and {"report_month", "scenario"} <= set(rows[0].asDict())


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES) <= set(entry.queries())
