"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from check import compare, connection

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connection(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_sql(spark, con, name):
    ok, text = compare(name, spark, SF, con)
    assert ok, text
    if name not in entry.oracle_sql():
        pytest.skip("no SQL: only rows and finite numbers were held")


def test_entry_has_rows(spark):
    frame = entry.entry(spark)
    assert "retail_viewed_count_percent" in frame.columns
    assert frame.count() > 0
