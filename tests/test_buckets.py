"""Tables in buckets of their keys: same results, and no exchange of what is stored."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from filingframe.operators import buckets, graph, resolve

ROWS = 3000


@pytest.fixture
def holders(spark):
    """A third of the rows has one key, some have none, and a key holds few of the others."""
    n = F.col("id")
    hot = n % 3 == 0
    return spark.range(ROWS, numPartitions=3).select(
        F.when(n % 50 == 1, None).when(hot, "hot").otherwise(F.concat(F.lit("i"), n % 97)).alias("ins_code"),
        F.when(n % 70 == 2, None).when(hot, 20230815).otherwise(20230800 + n % 31).cast("int").alias("d_even"),
        n.alias("holder's no"),
    )


@pytest.fixture
def targets(spark):
    """Every key once, one key very often, keys that nobody holds, and none."""
    n = F.col("id")
    return spark.range(900, numPartitions=2).select(
        F.when(n < 300, "i5").when(n == 300, None).when(n == 301, "hot").otherwise(F.concat(F.lit("i"), n % 120)).alias("ins_code"),
        F.when(n < 300, 20230805).when(n == 301, 20230815).otherwise(20230800 + n % 31).cast("int").alias("d_even"),
        n.alias("target"),
    )


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def nodes(df, name):
    return [line for line in plan(df).splitlines() if f"{name} " in line]


def test_parts(spark, tmp_path, holders):
    stored = buckets.write(holders, str(tmp_path / "t"), resolve.SNAPSHOT, buckets=8, rows_per_task=200)
    assert rows(stored.rows()) == rows(holders)
    keys = {tuple(r) for r in stored.rest.select(*stored.keys).distinct().collect()}
    assert ("hot", 20230815) in keys and all(k == ("hot", 20230815) or None in k for k in keys)
    assert stored.even.where("ins_code is null or d_even is null or ins_code = 'hot'").isEmpty()
    # one file a bucket
    assert 1 < stored.even.select(F.input_file_name()).distinct().count() <= 8


def test_join_equals_plain_join(spark, tmp_path, holders, targets):
    stored = buckets.write(holders, str(tmp_path / "t"), resolve.SNAPSHOT, buckets=8, rows_per_task=200)
    expected = rows(holders.join(targets, resolve.SNAPSHOT))
    assert len(expected) > ROWS // 3
    assert rows(stored.join(targets, rows_per_task=100)) == expected
    assert rows(stored.join(targets)) == expected
    few = targets.select(*resolve.SNAPSHOT).distinct()
    assert rows(stored.known(few)) == rows(few.join(holders, resolve.SNAPSHOT, "left_semi"))
    assert stored.join(targets.limit(0)).isEmpty()


def test_stored_side_has_no_exchange(spark, tmp_path, holders, targets):
    stored = buckets.write(holders, str(tmp_path / "t"), resolve.SNAPSHOT, buckets=8, rows_per_task=200)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = stored.even.join(targets, resolve.SNAPSHOT)
        assert len(nodes(joined, "SortMergeJoin")) == 1
        # the exchange of the targets alone, into as many partitions as there are buckets
        (exchange,) = nodes(joined, "Exchange")
        assert "hashpartitioning" in exchange and ", 8)" in exchange
        assert not nodes(stored.even.groupBy(*resolve.SNAPSHOT).count(), "Exchange")
        assert len(nodes(holders.join(targets, resolve.SNAPSHOT), "Exchange")) == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_newest_complete_table_counts(spark, tmp_path, holders):
    path = str(tmp_path / "it's")
    first = buckets.write(holders, path, ["ins_code"], buckets=4)
    second = buckets.write(holders.limit(10), path, ["ins_code"], buckets=4)
    assert (first.rows().count(), second.rows().count()) == (ROWS, 10)
    # a session that does not know the table reads it in its buckets all the same
    spark.sql(f"DROP TABLE {next(t.name for t in spark.catalog.listTables() if t.name in plan(second.even))}")
    again = buckets.read(spark, path)
    assert again.keys == ("ins_code",) and rows(again.rows()) == rows(second.rows())
    assert not nodes(again.even.groupBy("ins_code").count(), "Exchange")
    # a write that is lost before its record changes nothing
    holders.write.parquet(f"{path}/lost/rest")
    assert buckets.read(spark, path).rows().count() == 10
    empty = buckets.write(holders.limit(0), str(tmp_path / "empty"), ["ins_code"], buckets=4)
    assert empty.rows().isEmpty() and empty.even.dtypes == holders.dtypes
    with pytest.raises(ValueError, match="no bucketed table"):
        buckets.read(spark, str(tmp_path / "none"))


def test_as_of_join_with_stored_holders(spark, tmp_path):
    held = spark.createDataFrame(
        [("1", 20230816, "a"), ("1", 20230817, "late"), ("2", 20230818, "too late"), (None, 20230815, "none"), ("3", 20230815, "b")],
        "ins_code string, d_even int, shareHolderName string",
    )
    prices = spark.createDataFrame([("1", 20230816, 0.0, 5.0)], "ins_code string, d_even int, pClosing double, pc double")
    targets = spark.createDataFrame(
        [("c1", "x", "1", "2023-08-15"), ("c2", "x", "2", "2023-08-15"), ("c3", "x", None, "2023-08-15"),
         ("c4", "x", "3", None), ("c5", "x", "3", "2023-08-15")],
        "company string, assembly_date string, ins_code string, day string",
    ).withColumn("day", F.to_date("day"))
    stored = buckets.write(held, str(tmp_path / "t"), resolve.SNAPSHOT, buckets=4, rows_per_task=1)
    got = resolve.as_of_forward(targets, stored, prices)
    assert rows(got) == rows(resolve.as_of_forward(targets, held, prices))
    assert sorted((r["company"], r["shareHolderName"], r["pClosing"]) for r in got.collect()) == [
        ("c1", "a", 5.0), ("c5", "b", None)]


def test_incidence_of_stored_seats(spark, tmp_path):
    n = F.col("id")
    months = spark.range(600).select(
        F.lpad((n % 7).cast("string"), 10, "0").alias("rep_key"),
        F.concat(F.lit("c"), n % 40).alias("company"),
        F.concat((1400 + n % 3).cast("string"), F.lpad((1 + n % 12).cast("string"), 2, "0")).alias("month"),
        (1400 + n % 3).cast("string").alias("year"),
        F.struct(F.lit("n").alias("rep_name")).alias("first"),
    )
    stored = buckets.write(months, str(tmp_path / "t"), graph.SEAT, buckets=4, rows_per_task=5)
    assert rows(graph.incidence(stored)) == rows(graph.incidence(months))
    assert rows(graph.interlock_groups(stored)) == rows(graph.interlock_groups(months))
    assert not nodes(graph.incidence(stored.even), "Exchange")
