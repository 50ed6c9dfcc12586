"""Registered queries: names and columns everywhere, values against DuckDB at the smallest scale."""

import os

import pytest

import __spark_entry__ as registered
from compare import compare, connect

SMALL = "/root/testdata/sf0.001"


def test_every_oracle_has_a_query():
    assert set(registered.oracle_sql()) <= set(registered.queries())


def test_entry(spark):
    assert registered.entry(spark).columns == [
        "skill_key", "display_name", "category", "postings", "postings_with_text", "pct_of_postings",
    ]


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the driver's tables")
@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_same_rows_as_sql(spark, name):
    verdict = compare(spark, connect(SMALL), SMALL, registered.queries()[name], registered.oracle_sql()[name])
    assert verdict is None or verdict.startswith("no rows"), verdict
