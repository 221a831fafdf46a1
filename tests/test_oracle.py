"""Every named query against its SQL twin on the smallest data set."""

from __future__ import annotations

import pytest
from oracle import compare, connect

import __spark_entry__ as entry

PATH = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()
# A range of dates or a small data set may leave nothing to return.
MAY_BE_EMPTY = {"search_all_criteria"}


@pytest.fixture(scope="module")
def duck():
    return connect(PATH)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    problem = compare(spark, duck, QUERIES[name], SQL[name], PATH)
    assert problem is None or (problem == "both empty" and name in MAY_BE_EMPTY), problem


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, PATH).count() > 0


def test_entry_has_a_stable_schema(spark):
    df = entry.entry(spark)
    assert df.columns == ["symbol", "year", "announcement_count", "company_name", "letter_codes"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)
