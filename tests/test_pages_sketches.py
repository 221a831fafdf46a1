"""Stored pages and profiles that add up."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from filingframe.operators import pages, sketches


def test_a_page_reads_its_own_range(spark, tmp_path):
    path = str(tmp_path / "p")
    # ties in the order, and a null
    rows = spark.range(95).selectExpr("if(id = 50, null, id % 10) as k", "id")
    pages.write_ordered(rows, path, ["k"], span=20)
    wanted = sorted(((i % 10 if i != 50 else None), i) for i in range(95) if i != 50)
    stored = [(r["k"], r["id"]) for r in spark.read.parquet(f"{path}/rows").orderBy("row_no").collect()]
    assert [x for x in stored if x[0] is not None] == wanted and (None, 50) in stored
    for page in range(1, 15):
        found = pages.read_page(spark, path, page, 7).collect()
        assert [(r["k"], r["id"]) for r in found] == stored[(page - 1) * 7 : page * 7]
    assert pages.page_count(spark, path, 7) == 14
    assert pages.read_page(spark, path, 15, 7).count() == 0
    one = pages.read_page(spark, path, 2, 7)
    assert len(one.inputFiles()) > 0
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(range_no" in plan and "PushedFilters: [IsNotNull(row_no)" in plan
    sizes = [r["rows"] for r in pages.directory(spark, path).orderBy("range_no").collect()]
    assert sizes == [20, 20, 20, 20, 15]


def test_pages_of_nothing_and_of_wrong_arguments(spark, tmp_path):
    empty = spark.range(0).withColumn("k", F.lit("x"))
    pages.write_ordered(empty, str(tmp_path / "e"), ["k"])
    assert pages.read_page(spark, str(tmp_path / "e"), 1).count() == 0
    assert pages.page_count(spark, str(tmp_path / "e")) == 0
    with pytest.raises(ValueError, match="row_no"):
        pages.write_ordered(empty.withColumnRenamed("k", "row_no"), str(tmp_path / "f"), ["id"])
    with pytest.raises(ValueError, match="start from 1"):
        pages.read_page(spark, str(tmp_path / "e"), 0)


def test_the_union_is_the_merge_of_its_parts(spark):
    rows = spark.range(20_000).selectExpr(
        "id % 7 as day", "id as n", "concat('s', id % 3000) as s", "if(id % 4 = 0, null, id / 3D) as x",
        "array(id % 5) as a", "cast(null as string) as none",
    )
    parts = sketches.profile_parts(rows, "day")
    assert parts.count() == 7 * 5
    found = {r["column"]: r for r in sketches.estimates(sketches.unite(parts)).collect()}
    # parts united in two steps give the same counts
    some, rest = parts.where("part < 3"), parts.where("part >= 3")
    steps = sketches.unite(sketches.unite(some).unionByName(sketches.unite(rest)))
    again = {r["column"]: r for r in sketches.estimates(steps).collect()}
    exact = {"n": (20_000, 0, 20_000), "s": (20_000, 0, 3000), "x": (20_000, 5000, 15_000), "a": (20_000, 0, 5), "none": (20_000, 20_000, 0)}
    for name, (count, nulls, distinct) in exact.items():
        assert (found[name]["rows"], found[name]["nulls"]) == (count, nulls)
        assert abs(found[name]["distinct"] - distinct) <= 0.04 * distinct
        assert found[name]["distinct"] == again[name]["distinct"]
    assert (found["n"]["least"], found["n"]["most"]) == (0.0, 19_999.0)
    for q, p in (("q0", 0.25), ("q1", 0.5), ("q2", 0.75)):
        assert abs(found["n"][q] - p * 20_000) <= 0.01 * 20_000
        assert abs(again["n"][q] - p * 20_000) <= 0.01 * 20_000
    assert found["s"]["q1"] is None and found["none"]["least"] is None
    assert sketches.estimates(sketches.unite(sketches.profile_parts(rows.limit(0), "day"))).count() == 0
