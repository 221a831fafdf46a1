"""What the physical plans of all named queries must not contain."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry

PATH = "/root/testdata/sf0.001"
QUERIES = entry.queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream_")))
def test_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, PATH))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["filter_date_range", "symbol_year", "search_board_changes"])
def test_scans_read_only_needed_columns(spark, name):
    text = plan(QUERIES[name](spark, PATH))
    orders = next(line for line in text.splitlines() if "o_orderkey" in line and "FileScan" in line)
    assert "o_totalprice" not in orders.split("ReadSchema")[1]


def test_filters_reach_the_scan(spark, tmp_path):
    from filingframe.operators import search
    from filingframe.plans.views import letters

    landed = str(tmp_path / "letters")
    letters(spark, PATH).write.parquet(landed)
    found = search.search_letters(
        spark.read.parquet(landed), symbol=" nation_4 ", letter_code="ن-45", from_date="1375/01/01"
    )
    pushed = plan(found).split("PushedFilters")[1]
    for part in ("EqualTo(symbol,NATION_4)", "EqualTo(letter_code,ن-45)",
                 "GreaterThanOrEqual(publish_date_time,1375/01/01)"):
        assert part in pushed


def test_row_numbers_have_no_window_over_rows(spark):
    text = plan(QUERIES["url_batches"](spark, PATH))
    # the only window without a partition key runs over one count per partition
    assert text.count("Window ") == 1 and "HashAggregate" in text


def test_quartiles_of_a_table_shuffle_no_raw_rows(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES["describe_table"](spark, PATH))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # below each exchange on the column stands an aggregate, never the tall rows
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning(column" in line:
            assert "HashAggregate" in lines[i + 1] or "SortAggregate" in lines[i + 1] or "Project" in lines[i + 1], lines[i + 1]
    assert "BroadcastExchange" in text
