"""Every registered query against its SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from headway.oracle import ORACLES
from headway.queries import all_queries
from tools.check_oracles import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(all_queries()) == set(ORACLES)
    assert set(entry.queries()) >= set(all_queries())
    assert set(entry.queries()) >= set(entry.oracle_sql()) >= set(ORACLES)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query(spark, con, name):
    ok, note = compare(spark, con, SF_DIR, name)
    assert ok, note


def test_entry(spark):
    df = entry.entry(spark)
    assert "spheroid_m" in df.columns
    assert df.count() > 0
